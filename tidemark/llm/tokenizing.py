"""Encoders over public vocabulary files, one per Python worker."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from tidemark.llm.units import UnitEncoder

#: Between units that are encoded in one call: a line end where white space is coded, else
#: a private-use character, which is a word of its own.
SEPARATORS = {True: "\n", False: "  "}
#: Few enough that the library does not slow down with the length of what it gets.
JOINED = 30
#: Units that are encoded by themselves: they are empty, hold a separator, end in white space
#: or start with more of it than one space.
APART = re.compile("^\\Z|\\s\\Z|^\\s\\s|^[^\\S ]|[\n\ue000]")
#: What any such unit shows in many that are joined by line ends.
SOME_APART = re.compile("\\s\n|\n\\s\\s|\n[^\\S ]|\ue000")


@lru_cache(maxsize=4)
def library_encoder(path: str, spaced: bool) -> UnitEncoder:
    """Ids by the tokenizers library, as little-endian 32-bit numbers.

    Strings of special tokens in a text are ordinary text. Units go to the library many at
    a time, joined by a separator that no unit holds; the ids are cut where the separator's
    own ids stand, which nothing but the separator can give.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in found]

    mark = SEPARATORS[spaced]
    mark_list = ids_of([mark])[0].tolist()

    def encode_units(units: list[str]) -> list[bytes]:
        together, alone = [], []
        for k in range(0, len(units), 1000):
            group = units[k : k + 1000]
            lines = "\n".join(["", *group, ""])
            if SOME_APART.search(lines) or lines.count("\n") != len(group) + 1:
                alone += [u for u in group if APART.search(u)]
                together += [u for u in group if not APART.search(u)]
            else:
                together += group
        groups = [together[k : k + JOINED] for k in range(0, len(together), JOINED)]
        found = tokenizer.encode_batch_fast([mark.join(g) for g in groups], add_special_tokens=False)
        # All groups in one array, each with the separator after it, so that one pass cuts them.
        flat: list[int] = []
        group_ends = []
        for encoding in found:
            flat += encoding.ids
            flat += mark_list
            group_ends.append(len(flat))
        ids = np.array(flat, dtype="<u4")
        hits = ids[: len(ids) - len(mark_list) + 1] == mark_list[0]
        for j in range(1, len(mark_list)):
            hits = hits & (ids[j : len(ids) - len(mark_list) + 1 + j] == mark_list[j])
        cuts = np.flatnonzero(hits)
        counts = np.cumsum([len(g) for g in groups])
        if not np.array_equal(np.searchsorted(cuts, group_ends), counts):
            raise ValueError("the separator of units was found a wrong number of times")
        data, step = ids.tobytes(), 4 * len(mark_list)
        ends = (4 * cuts).tolist()
        coded = [data[a:b] for a, b in zip([0, *(e + step for e in ends[:-1])], ends, strict=False)]
        if not alone:
            return coded
        out = dict(zip(together, coded, strict=True))
        out.update(zip(alone, (ids.tobytes() for ids in ids_of(alone)), strict=True))
        return [out[u] for u in units]

    return UnitEncoder(encode_units, spaced)
