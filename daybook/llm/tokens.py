"""Token ids of whole texts inside tasks.

The vocabularies that this serves never join characters across white space, nor a letter and the sign or digit beside
it, nor two digits, so a text's ids are those of its runs between such places, one after the other. Most runs are seen
many times: each is encoded once and remembered.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import chain

#: Runs that a worker remembers, and the longest one.
REMEMBERED, LONGEST = 800_000, 48
_BLANKS = str.maketrans({"\n": " ", "\t": " ", "\r": " "})
_LETTER, _SIGN = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
#: A blank goes after a match. Apostrophes (contractions) and characters beyond Latin-1 stay with what is beside them.
_BREAK = re.compile(f"([{_LETTER}](?=[0-9{_SIGN}])|[{_SIGN}](?=[0-9{_LETTER}])|[0-9](?=[0-9{_LETTER}{_SIGN}]))")
_PLAIN, _TOGETHER = re.compile(f"[{_LETTER}]+"), 200


def runs(text: str) -> list[str]:
    """The parts of a text that are encoded by themselves; small letters for capitals where the text is Latin-1."""
    if "<|" in text:  # special tokens stay whole
        return text.translate(_BLANKS).split(" ")
    if text.isascii() or max(text) <= "ÿ":
        text = text.lower()
    return _BREAK.sub(r"\1 ", text).translate(_BLANKS).split(" ") if "\t" in text or "\r" in text else (
        _BREAK.sub(r"\1 ", text).replace("\n", " ").split(" "))


class Encoder:
    """``encode(texts)``: for each text its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._seen: dict[str, bytes] = {"": b""}

    def _ids(self, new: list[str]) -> dict[str, bytes]:
        """Ids of each run. Words go together, as that is faster; the tokenizer says which word a token is of."""
        plain, other = [], []
        for run in new:
            (plain if _PLAIN.fullmatch(run) else other).append(run)
        found = {}
        groups = [plain[i:i + _TOGETHER] for i in range(0, len(plain), _TOGETHER)]
        for group, e in zip(groups, self._tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)):
            ids: list[list[int]] = [[] for _ in group]
            for word, i in zip(e.word_ids, e.ids):
                ids[word].append(i)
            found |= {run: array("I", own).tobytes() for run, own in zip(group, ids)}
        for run, e in zip(other, self._tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            found[run] = array("I", e.ids).tobytes()
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [runs(t) for t in texts]
        if len(self._seen) > REMEMBERED:
            self._seen = {"": b""}
        known = self._seen
        found = self._ids(list(set(chain.from_iterable(split)).difference(known)))
        known.update(found)
        out = [b"".join(map(known.__getitem__, parts)) for parts in split]
        for run in found:
            if len(run) > LONGEST:
                del known[run]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def in_slices(texts: list[str], chars: int = 2_000_000):
    """(first, texts): runs of texts of some ``chars`` characters, so that what a slice needs is bounded by its texts."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i == len(texts) - 1:
            yield at, texts[at:i + 1]
            at, size = i + 1, 0
