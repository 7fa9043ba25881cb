"""Toxicity by two Kneser-Ney models of words, one per class, with shared backoff counts."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import (
    filter_of,
    in_slices,
    quoted,
    rows_of,
    saved,
    text_mark,
    texts,
)

#: Characters of a word that make its stem, to which a word that is rare or new backs off.
STEM = 5
DISCOUNT = 0.75
#: An expression counts as telling if the likelihood ratio test of its class counts reaches this,
#: which one in ten thousand does by chance.
TELLING = 15.0
#: And only if it is so much likelier in one of the classes, as a logarithm: in large corpora small
#: differences are beyond chance too, and say little.
EFFECT = 0.7
#: A word is strong evidence if it is so much likelier in toxic text, as a logarithm.
STRONG = 1.0
#: Labelled rows that the weights are fitted on, at most.
FIT_ROWS = 20_000
#: Words that a task gathers before it sends their counts on.
GATHERED = 500_000

#: Folds whose labels may be used. Fold 2 is held out.
LEARNED = (0, 1, 3)
#: A model of all these folds, and one without each of them.
VARIANTS = (None, *LEARNED)

#: ASCII signs and digits separate words.
_SIGNS = bytes.maketrans(bytes([*range(0x21, 0x41), *b"[\\]^_`{|}~"]), b" " * 42)


def words_of_text(text: str) -> list[bytes]:
    """Words in lower case: what white space, ASCII signs and digits leave."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_SIGNS).split()


def _text(word: bytes) -> str:
    return word.decode("utf-8", "replace")


def _types(batches):
    """Words of the texts of a task, each once or a few times."""
    met = set()
    for b in batches:
        for text in b["text"]:
            met.update(words_of_text(text))
            if len(met) >= GATHERED:
                yield pd.DataFrame({"word": list(map(_text, met))})
                met = set()
    yield pd.DataFrame({"word": list(map(_text, met))})


def _class_words(batches):
    """Counts of words by fold and label."""

    def frame(met):
        rows = [(_text(w), *key, n) for key, counts in met.items() for w, n in counts.items()]
        return pd.DataFrame(rows, columns=["word", "fold", "label", "n"]).astype({"fold": "int32", "label": "int32"})

    met = {}
    for b in batches:
        for text, label, own in zip(b["text"], b["label"], b["fold"], strict=True):
            met.setdefault((own, label), Counter()).update(words_of_text(text))
            if sum(map(len, met.values())) >= GATHERED:
                yield frame(met)
                met = {}
    if met:
        yield frame(met)


def _name(kind: str, label: int, left_out: int | None) -> str:
    return f"{kind}{label}_{'all' if left_out is None else left_out}"


def word_counts(learn: DataFrame) -> DataFrame:
    """``word`` and ``n0_all``, ``n1_all``, ``n0_0`` ...: counts by class, in all folds and without one."""
    counted = in_slices(learn, _class_words, "word string, fold int, label int, n long")
    sums = []
    for left_out in VARIANTS:
        for label in (0, 1):
            used = (F.col("label") == label) & (F.lit(True) if left_out is None else F.col("fold") != left_out)
            sums.append(F.sum(F.when(used, F.col("n")).otherwise(0)).alias(_name("n", label, left_out)))
    return counted.groupBy("word").agg(*sums)


def _stem(word: str = "word") -> Column:
    return F.substring(word, 1, STEM)


def stem_types(rows: DataFrame) -> DataFrame:
    """``stem, types``: how many different words of all documents begin with a stem."""
    met = in_slices(rows.select("text"), _types, "word string").distinct()
    return met.groupBy(_stem().alias("stem")).agg(F.count(F.lit(1)).alias("types"))


def _telling(n: list[Column], total: list[float], least: float) -> Column:
    """Whether class counts differ from what the sizes of the classes let expect."""
    both = n[0] + n[1]
    parts = [
        F.when(c > 0, c * F.log(c / (both * (t / sum(total))))).otherwise(0.0) for c, t in zip(n, total, strict=True)
    ]
    return 2 * (parts[0] + parts[1]) >= least


def expressions(
    words: DataFrame, stems: DataFrame, discount: float = DISCOUNT, least: float = TELLING, effect: float = EFFECT
):
    """Log-likelihood ratios of telling expressions: by ``word``, and by ``stem``.

    Columns ``llr_all``, ``llr_0`` ... are those of the variants. A stem has the discounted share of
    its class; what the discount frees goes to all stems by the number of different words that
    begin with them in any document. A word has its stem's probability times its discounted share
    of it, and what is freed there goes to all words with the stem alike. So a word that a
    class has rarely or never seen is judged by how many words of its kind there are at all.
    Expressions whose counts are not telling keep the ratio of what they back off to.
    """
    names = [_name("n", label, v) for v in VARIANTS for label in (0, 1)]
    kinds = [F.sum((F.col(n) > 0).cast("long")).alias(f"k{n[1:]}") for n in names]
    of_stem = words.groupBy(_stem().alias("stem")).agg(*[F.sum(n).alias(n) for n in names], *kinds)
    of_stem = saved(of_stem.join(stems, "stem"), "toxicity-stems")
    total = of_stem.agg(
        *[F.sum(n).alias(n) for n in names], *[F.sum((F.col(n) > 0).cast("long")).alias(f"k{n[1:]}") for n in names]
    ).first()
    all_types = stems.agg(F.sum("types")).first()[0] or 1
    stem_llr, word_llr, telling_words = {}, {}, []
    for v in VARIANTS:
        size = [float(total[_name("n", label, v)] or 0) for label in (0, 1)]
        llr = f"llr_{'all' if v is None else v}"
        if not all(size):
            stem_llr[llr] = word_llr[llr] = F.lit(0.0)
            continue
        ends = []
        for label in (0, 1):
            n, freed = F.col(_name("n", label, v)), discount * total[_name("k", label, v)]
            shared = F.col("types") / all_types
            ends.append((F.greatest(n - discount, F.lit(0.0)) + freed * shared) / size[label])
        n = [F.col(_name("n", label, v)) for label in (0, 1)]
        ratio = F.log(ends[1] / ends[0])
        stem_llr[llr] = F.when(_telling(n, size, least) & (F.abs(ratio) >= effect), ratio).otherwise(0.0)
        inner = []
        for label in (0, 1):
            name = _name("n", label, v)
            n, of, k = F.col(name), F.col(f"s_{name}"), F.col(f"s_k{name[1:]}")
            seen = F.when(of > 0, F.greatest(n - discount, F.lit(0.0)) / of).otherwise(0.0)
            inner.append(seen + F.when(of > 0, discount * k / of).otherwise(1.0) / F.col("s_types"))
        n = [F.col(_name("n", label, v)) for label in (0, 1)]
        ratio = F.log(inner[1] / inner[0])
        telling = _telling(n, size, least) & (F.abs(ratio) >= effect)
        telling_words.append(telling)
        word_llr[llr] = F.col(f"s_{llr}") + F.when(telling, ratio).otherwise(0.0)
    judged = saved(of_stem.withColumns(stem_llr), "toxicity-judged")
    prefixed = judged.select("stem", *[F.col(c).alias(f"s_{c}") for c in judged.columns if c != "stem"])
    any_telling = telling_words[0] if telling_words else F.lit(False)
    for t in telling_words[1:]:
        any_telling = any_telling | t
    longer = words.withColumn("stem", _stem()).filter("word <> stem").join(prefixed, "stem")
    by_word = longer.filter(any_telling).select("word", *[c.alias(n) for n, c in word_llr.items()])
    used = " or ".join(f"{n} <> 0" for n in stem_llr)
    return saved(by_word, "toxicity-words"), saved(judged.select("stem", *stem_llr).filter(used), "toxicity-expressions")


def _prints(batches):
    for b in batches:
        prints = [xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in b["x"]]
        yield pd.DataFrame({"print": np.array(prints, np.uint64).astype(np.int64)})


class _Hits(dict):
    """For each word, the word and its stem as text if the table of expressions may have one of them."""

    def __init__(self, words: np.ndarray, stems: np.ndarray):
        self.filters = words, stems

    def __missing__(self, word: bytes):
        if len(self) >= GATHERED:
            self.clear()
        text = _text(word)
        hit = None
        for bits, x in zip(self.filters, (text, text[:STEM]), strict=True):
            at = xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) & (64 * len(bits) - 1)
            if int(bits[at >> 6]) >> (at & 63) & 1:
                hit = (text, text[:STEM])
        self[word] = hit
        return hit


def _weighed(words, stems):
    def weigh(batches):
        hits = _Hits(words.value, stems.value)
        for b in batches:
            rows = []
            for text in b["text"]:
                found = words_of_text(text)
                some = [(hit, n) for w, n in Counter(found).items() if (hit := hits[w])]
                rows.append((len(found), [h[0] for h, _ in some], [h[1] for h, _ in some], [n for _, n in some]))
            n, word, stem, times = zip(*rows, strict=True) if rows else ((), (), (), ())
            out = {"doc_id": b["doc_id"].astype("Int64"), "text_mark": b["text_mark"], "n": n}
            yield pd.DataFrame(out | {"word": word, "stem": stem, "times": times}).astype(
                {"n": "int64", "word": object, "stem": object, "times": object}
            )

    return weigh


def fit_weights(x: np.ndarray, y: np.ndarray, steps: int = 30) -> np.ndarray:
    """Logistic regression with a small penalty, by Newton's method; columns are standardised."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    ridge = np.diag([1e-6, *[1e-2] * x.shape[1]])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge
        w = w + np.linalg.solve(hessian, z.T @ (y - p) - ridge @ w)
        w = np.clip(w, -30, 30)
    w[1:] /= scale
    w[0] -= w[1:] @ mean
    return w


def fold(doc_id: Column) -> Column:
    """0 to 3, by the CRC-32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = 0.3,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per input row: ``doc_id, text_mark, held_out, score, predicted``.

    Rows of fold 2 are held out: their labels are never used. The counts of both models cover
    every labelled row of the other folds, and the shared backoff counts every row; both are tables
    that grow with the corpus. Words of a document that the table of telling expressions may
    have, by a filter of a bounded size, are joined with it; all other words are as likely in
    one class as in the other. The evidence is the log-likelihood ratio per word, and the share
    of strong words, weighed by how many words it is taken from. The weights that turn it into a
    score are fitted on labelled rows of those folds, at most ``fit_rows`` of them (those with the
    smallest hash of the id), whose evidence is taken from a model without their own fold.

    A null text is empty; an empty text has no evidence and gets the score of no evidence.
    Labels other than 0 and 1 and labels of null ids are not used; an id with two labels counts
    for both. Without rows of both classes in a part that needs them, every score is 0. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col)
    known = saved(
        labels.select(quoted(id_col).cast("long").alias("doc_id"), quoted(label_col).cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)")
        .distinct()
        .filter(fold(F.col("doc_id")) != 2)
        .withColumn("fold", fold(F.col("doc_id")).cast("int")),
        "labels",
    )
    words = saved(word_counts(rows_of(rows, known).select("text", "label", "fold")), "toxicity-counts")
    by_word, by_stem = expressions(words, saved(stem_types(rows), "toxicity-types"))
    filters = [
        filter_of(spark, in_slices(t.select(F.col(c).alias("x")), _prints, "print long"))
        for t, c in ((by_word, "word"), (by_stem, "stem"))
    ]
    marked = rows.withColumn("text_mark", text_mark(F.col("text")))
    weighed = in_slices(
        marked,
        _weighed(*filters),
        "doc_id long, text_mark long, n long, word array<string>, stem array<string>, times array<long>",
    )
    weighed = saved(weighed.withColumn("row", F.monotonically_increasing_id()), "toxicity-hits")
    hits = weighed.select("row", F.explode(F.arrays_zip("word", "stem", "times")).alias("hit")).select("row", "hit.*")
    ratios = [f"llr_{'all' if v is None else v}" for v in VARIANTS]
    named = lambda t, key, side: t.select(key, *[F.col(r).alias(f"{side}_{r}") for r in ratios])
    joined = hits.join(named(by_word, "word", "w"), "word", "left").join(named(by_stem, "stem", "s"), "stem", "left")
    sums = []
    for r in ratios:
        llr = F.coalesce(F.col(f"w_{r}"), F.col(f"s_{r}"), F.lit(0.0))
        sums += [F.sum(llr * F.col("times")).alias(f"sum_{r}"), F.sum(F.when(llr > STRONG, F.col("times"))).alias(f"strong_{r}")]
    evidence = saved(joined.groupBy("row").agg(*sums), "toxicity-evidence")
    found = weighed.select("row", "doc_id", "text_mark", "n").join(evidence, "row", "left")

    def features(r: str) -> list[Column]:
        n = F.greatest(F.col("n"), F.lit(1))
        return [
            (F.coalesce(F.col(f"sum_{r}"), F.lit(0.0)) / n).alias("mean"),
            (F.coalesce(F.col(f"strong_{r}"), F.lit(0)) / F.sqrt(n)).alias("strong"),
        ]

    # Some more ids than rows wanted, because not every label has its document.
    chosen = rows_of(found.select(*found.columns), known)
    own = [F.when(F.col("fold") == v, F.struct(*features(f"llr_{v}"))) for v in LEARNED]
    fit = (
        chosen.select("doc_id", "text_mark", "label", F.coalesce(*own).alias("x"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label", "text_mark")
        .limit(fit_rows)
        .select("label", "x.*")
        .toPandas()
    )
    held_out = fold(F.col("doc_id")) == 2
    if fit["label"].nunique() < 2:
        score = F.lit(0.0)
    else:
        w = fit_weights(fit[["mean", "strong"]].to_numpy(float), fit["label"].to_numpy(float))
        mean, strong = features("llr_all")
        z = F.lit(float(w[0])) + mean * float(w[1]) + strong * float(w[2])
        score = 1 / (1 + F.exp(-z))
    scored = found.select("doc_id", "text_mark", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
