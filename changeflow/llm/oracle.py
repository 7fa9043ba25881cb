"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

from changeflow.llm.common import UPPER

#: A word: no ASCII white space in it.
WORD = r"[^\x20\x09-\x0D]+"



def _leaf(n_chars: str) -> str:
    """The columns of a row as its leaf has them."""
    columns = ("doc_id", "source", "lang", n_chars, "text")
    return " || ".join(
        f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in columns
    )


def _similar(size: int, percent: int) -> str:
    """Components of documents linked by their runs of words."""
    return rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS w
            FROM documents),
        grams AS (
            SELECT DISTINCT doc_id, array_to_string(w[p : p + {size} - 1], ' ') AS g
            FROM d, unnest(range(1, greatest(len(w) - {size} + 2, 2))) AS t(p) WHERE len(w) > 0),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
            FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT x, y FROM shared JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
            WHERE 100 * o >= {percent} * (sx.n + sy.n - o)),
        edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reached AS (
            SELECT doc_id AS x, doc_id AS y FROM d
            UNION SELECT r.x, e.y FROM reached r JOIN edges e ON r.y = e.x)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM d LEFT JOIN sizes USING (doc_id)
        JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) USING (doc_id)
    """


#: The level above a list of digests, and the step of a proof at one level (end: only the root is left).
_NEXT = "list_transform(range((len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], '')))"
_STEP = """CASE WHEN len(l) = 1 THEN 'end' WHEN (pos >> lv) & 1 = 1 THEN 'L' || l[(pos >> lv)]
    ELSE 'R' || coalesce(l[(pos >> lv) + 2], '') END"""

ORACLE_SQL = {
    "op1_exact_dedup": f"""
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY t)
    """,
    "op2_ngram_join": _similar(3, 90),
    "op10_phrase_dedup": rf"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
        windows AS (
            SELECT doc_id, p, array_to_string(w[p : p + 49], ' ') AS k
            FROM d, unnest(range(1, len(w) - 48)) AS t(p)),
        firsts AS (SELECT k, min(doc_id) AS first_id FROM windows GROUP BY k),
        hits AS (SELECT doc_id, p FROM windows JOIN firsts USING (k) WHERE first_id < doc_id),
        gone AS (SELECT DISTINCT doc_id, p + o AS p FROM hits, range(0, 50) AS t(o)),
        words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS rest
            FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(rest, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op11_merkle": rf"""
        WITH RECURSIVE d AS (
            SELECT *, list_reduce(
                list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
                lambda crc, c: list_reduce(
                    list_prepend(xor(crc, c), range(8)::UBIGINT[]),
                    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, {0xEDB88320}::UBIGINT) ELSE x >> 1 END)) AS crc
            FROM documents),
        claims AS (
            SELECT *, CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS claimed
            FROM d),
        hashed AS (
            SELECT doc_id, lang, sha256({_leaf("n_chars")}) AS leaf, sha256({_leaf("claimed")}) AS tried
            FROM claims),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
        tree AS (
            SELECT lang, 0 AS lv, list(leaf ORDER BY pos) AS l FROM placed GROUP BY lang
            UNION ALL SELECT lang, lv + 1, {_NEXT} FROM tree WHERE len(l) > 1),
        subroots AS (SELECT lang, l[1] AS subroot FROM tree WHERE len(l) = 1),
        ranked AS (
            SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM subroots),
        top AS (
            SELECT 0 AS lv, list(subroot ORDER BY pos) AS l FROM ranked
            UNION ALL SELECT lv + 1, {_NEXT} FROM top WHERE len(l) > 1),
        low AS (
            SELECT p.doc_id, p.lang, p.leaf, p.tried, list({_STEP} ORDER BY t.lv) AS steps
            FROM placed p JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang
            GROUP BY ALL),
        high AS (
            SELECT p.lang, p.subroot, list({_STEP} ORDER BY t.lv) AS steps FROM ranked p, top t GROUP BY ALL),
        paths AS (
            SELECT doc_id, leaf, subroot, tried,
                   list_filter(list_concat(low.steps, high.steps), lambda s: s <> 'end') AS steps
            FROM low JOIN high ON low.lang IS NOT DISTINCT FROM high.lang),
        folded AS (
            SELECT doc_id, leaf, subroot,
                   sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
                   list_reduce(list_prepend('x' || tried, steps), lambda a, s: 'x' || sha256(
                       CASE s[1] WHEN 'L' THEN s[2:] || a[2:] ELSE a[2:] || s[2:] END))[2:] AS folded_root
            FROM paths)
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
        FROM folded, (SELECT l[1] AS root FROM top WHERE len(l) = 1)
    """,
    "op12_phrases": rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        runs AS (
            SELECT lang, m, array_to_string(w[p : p + m - 1], ' ') AS phrase
            FROM words, range(1, 4) AS s(m), unnest(range(1, len(w) - m + 2)) AS t(p)),
        totals AS (SELECT lang, count(*) AS n FROM runs WHERE m = 1 GROUP BY lang),
        f AS (SELECT lang, m, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 10),
        cuts AS (
            SELECT lang, m, phrase, f AS a, k, string_split(phrase, ' ') AS w
            FROM f, range(1, 3) AS c(k) WHERE m > k),
        scored AS (
            SELECT c.lang, c.m, c.phrase, a, k, x.f AS l, y.f AS r,
                   (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 : c.m], ' ')),
        weakest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_ones AS (
            SELECT lang, f AS longer, array_to_string(string_split(phrase, ' ')[p : p + 1], ' ') AS phrase
            FROM f, range(1, 3) AS i(p) WHERE m = 3),
        hidden AS (SELECT lang, phrase, max(longer) AS longer FROM inner_ones GROUP BY ALL),
        kept AS (
            SELECT w.* FROM weakest w LEFT JOIN hidden h ON h.lang = w.lang AND h.phrase = w.phrase
            WHERE h.longer IS NULL OR 100 * h.longer < 50 * w.a),
        ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
        SELECT r.lang, rank, phrase, a, l, r, n, score
        FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000
    """,
    "op13_minhash": f"SELECT *, doc_id = component_id AS kept FROM ({_similar(5, 85)})",
}
