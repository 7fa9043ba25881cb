"""Token ids of whole texts, by a tokenizer file of the ``tokenizers`` library."""

from __future__ import annotations

import json
import os
import re
import sys
from types import ModuleType

import numpy as np

#: A space that the word after it does not take along, because white space stands on both sides.
LOOSE = re.compile(r"\s (?:\s|\Z)")
#: Pieces longer than this are not remembered, and so many are remembered at most.
LONGEST_KNOWN, MOST_KNOWN = 48, 200_000
#: Pieces that go through the tokenizer as one text.
TOGETHER = 500


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def largest_id(path: str) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0)


def encoder_for(path: str, width: int = 4) -> TextEncoder:
    """One encoder in a worker process; tasks that run there later find its pieces known."""
    kept = sys.modules.setdefault("_changeflow_encoders", ModuleType("_changeflow_encoders"))
    if getattr(kept, "key", None) != (path, width):
        kept.key, kept.encoder = (path, width), TextEncoder(path, width)
    return kept.encoder


class TextEncoder:
    """Ids of texts as bytes, little-endian with ``width`` bytes an id.

    A byte-level BPE cuts a text before every space that a word follows, whatever stands around
    it. So a text is split there, and the ids of a piece are looked up; words repeat, so most of the
    work goes away. New pieces go through the tokenizer many at a time, joined to one text, and the
    bytes that each id stands for tell where a piece ends. Texts with a special token, and
    tokenizers of another kind, are encoded as a whole.
    """

    def __init__(self, path: str, width: int = 4):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut = spec.get("pre_tokenizer") or {}
        self.by_piece = (
            spec.get("normalizer") is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space")
        )
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.kind = f"<u{width}"
        self.width = width
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # A byte-level token has one character for each byte.
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)

    def _whole(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), 2000):
            for e in self.tokenizer.encode_batch_fast(texts[i : i + 2000], add_special_tokens=False):
                out.append(np.array(e.ids, self.kind).tobytes())
        return out

    def _pieces(self, text: str) -> list[str] | None:
        """The first piece as it is, the others without the space before them."""
        if not self.by_piece or any(s in text for s in self.special):
            return None
        pieces = text.split(" ")
        if LOOSE.search(text):
            joined = pieces[:1]
            for i, p in enumerate(pieces[1:], 1):
                before = joined[-1]
                loose = before[-1].isspace() if before else i > 1
                if loose and (not p or p[0].isspace()):
                    joined[-1] = f"{before} {p}"
                else:
                    joined.append(p)
            pieces = joined
        return pieces

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, each with the space before it."""
        spaced = [f" {p}" for p in pieces]
        out: list[bytes | None] = [None] * len(pieces)
        # What begins with white space would run together with the piece before it.
        safe = [i for i, p in enumerate(pieces) if p and not p[0].isspace()]
        groups = [safe[i : i + TOGETHER] for i in range(0, len(safe), TOGETHER)]
        for i in range(0, len(groups), 64):
            some = groups[i : i + 64]
            texts = ["".join([spaced[k] for k in group]) for group in some]
            for group, e in zip(
                some, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True
            ):
                ids = np.array(e.ids, self.kind)
                ends = np.cumsum(self.sizes[ids])
                wanted = np.cumsum([len(spaced[k].encode()) for k in group])
                places = np.searchsorted(ends, wanted)
                if len(ends) and places[-1] < len(ends) and (ends[places] == wanted).all():
                    data, at = ids.tobytes(), 0
                    for k, to in zip(group, ((places + 1) * self.width).tolist(), strict=True):
                        out[k] = data[at:to]
                        at = to
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(rest, self._whole([spaced[k] for k in rest]), strict=True):
            out[k] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self._pieces(t) for t in texts]
        if len(self.known) > MOST_KNOWN:
            self.known.clear()
        wanted = set()
        for pieces in split:
            if pieces:
                wanted.update(pieces[1:])
        wanted.difference_update(self.known)
        new = list(wanted)
        self.known.update(zip(new, self._learn(new), strict=True))
        # What has no space before it: first pieces, and texts that are not split.
        wholes = self._whole(
            [t if pieces is None else pieces[0] for t, pieces in zip(texts, split, strict=True)]
        )
        get = self.known.__getitem__
        out = [
            first if pieces is None else first + b"".join(map(get, pieces[1:]))
            for first, pieces in zip(wholes, split, strict=True)
        ]
        for p in new:
            if len(p) > LONGEST_KNOWN:
                del self.known[p]
        return out
