"""Token ids of many texts through the tokenizers library, word by word.

A text is cut before every single space that a character other than white space
follows. The pre-tokenizer's pattern never matches across such a cut (`` ?x+``
takes the space, white space before it is a match of its own, and no special
string holds a space), so the parts can be encoded apart and each different part
only once. Parts that are new to a task are encoded together, joined again in
texts of about ``JOINED_BYTES``; the bytes of the tokens tell where each part ends.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

JOINED_BYTES = 1 << 16
#: Parts that a worker remembers at most; beyond, it forgets them all.
REMEMBERED = 200_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    itself where it is printable and not white space, else one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def parts(text: str) -> list[str]:
    """The text's parts; all but the first lack their leading space."""
    raw = text.split(" ")
    if not any(not p or p[0].isspace() for p in raw[1:]):
        return raw
    out = [raw[0]]
    for p in raw[1:]:
        if not p or p[0].isspace():
            out[-1] += " " + p
        else:
            out.append(p)
    return out


class PartEncoder:
    """Remembers a value made of the ids of each part seen."""

    def __init__(self, tokenizer, token_bytes: Callable[[int], int], n_tokens: int, value: Callable[[np.ndarray], object]):
        self.tokenizer, self.value = tokenizer, value
        self.lengths = np.array([token_bytes(i) for i in range(n_tokens)], np.int64)
        self.known: dict[str, object] = {}

    def learn(self, new: Iterable[str]) -> None:
        group: list[str] = []
        size = 0
        for p in new:
            group.append(p)
            size += len(p) + 1
            if size >= JOINED_BYTES:
                self._encode(group)
                group, size = [], 0
        if group:
            self._encode(group)

    def _encode(self, group: list[str]) -> None:
        # Joined before a single space each; a part that ends in white space is as safe as any.
        ids = np.array(self.tokenizer.encode(" " + " ".join(group), add_special_tokens=False).ids, np.int32)
        ends = np.cumsum(self.lengths[ids])
        wanted = np.cumsum([len(p.encode()) + 1 for p in group])
        cut = np.searchsorted(ends, wanted)
        if not np.array_equal(ends[cut], wanted):
            raise ValueError("a token crosses a cut")
        lo = 0
        for p, c in zip(group, cut.tolist(), strict=True):
            self.known[p] = self.value(ids[lo : c + 1])
            lo = c + 1

    def __call__(self, texts: list[str]) -> list[list[object]]:
        """For each text its parts' values; a first part has no leading space and
        stands in a list of its own encoding."""
        cut = [parts(t) for t in texts]
        new = set()
        for p in cut:
            new.update(p[1:])
        new -= self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = {x for p in cut for x in p[1:]}
        self.learn(sorted(new))
        known = self.known
        heads = self.tokenizer.encode_batch([p[0] for p in cut], add_special_tokens=False)
        return [[self.value(np.array(h.ids, np.int32)), *[known[x] for x in p[1:]]] for p, h in zip(cut, heads, strict=True)]
