"""Token ids of whole texts by way of small units that are encoded once and remembered.

A text is cut only where its tokenizer certainly cuts as well, so joining the ids of the
units gives the ids of the whole text. Every unit itself is encoded by the given encoder.
Cutting, finding the distinct parts of a batch and joining are done by Arrow; Python looks up
each distinct part of a batch once, and handles by itself only new parts with white space in
them or at the start of a text or line.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Put before the first part of a text and before parts after a line end, which tells
#: them from parts after a space.
START, LINE = "\ue001", "\ue002"
#: Control characters that Python takes for white space and the tokenizers do not, and the
#: two characters above.
ODD = "[\x1c-\x1f\u0085\ue001\ue002]"
#: A line end beside other white space.
LOOSE_LINE = LINE + r"([\s\pZ]|$)"
RUNS = re.compile(r"\s+|\S+")
MARKS = ",.;:!?%&$#*"
#: Parts that are a word, perhaps with marks after it, and nothing else. White space is named in
#: full, as the patterns of Python and Arrow differ in it.
WHOLE_WORD = r"^[^\s\pZ\x0b\x1c-\x1f\x{85}\x{e001}\x{e002}]+$"
#: The last character of a word whose marks may be cut off, by ``spaced``.
PLAIN_END = {True: r"[\pL\p{Nd}]$", False: r"[A-Za-z0-9]$"}
#: A letter or digit and then only marks: a cut for every tokenizer that takes texts as they are.
MARKS_AFTER_WORD = re.compile(r"(\S*[^\W_])([,.;:!?%&$#*]+)\Z")
#: The same for vocabularies that compose and lower-case a text first: other letters may come
#: apart there, and their last part need not be a letter. These stay themselves.
MARKS_AFTER_PLAIN = re.compile(r"(\S*[A-Za-z0-9])([,.;:!?%&$#*]+)\Z")
MAX_UNITS = 1_000_000


def _strings(texts: pa.Array) -> list[str]:
    """The texts as Python strings, by numpy: ``to_pylist`` makes a scalar of each first."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def _large(text: str) -> pa.Scalar:
    return pa.scalar(text, pa.large_string())


def spaced_units(text: str) -> list[str]:
    """Units for the splitting pattern of byte-level vocabularies.

    The last space of a white-space run belongs to the word after it; the rest of the run
    is a match of its own, and so is a last character that is not a space.
    """
    runs = RUNS.findall(text)
    out, space = [], ""
    for i, run in enumerate(runs):
        if not run[0].isspace():
            out += word_units(run, space)
            space = ""
        elif i + 1 == len(runs):
            out.append(run)
        else:
            if len(run) > 1:
                out.append(run[:-1])
            if run[-1] == " ":
                space = " "
            else:
                out.append(run[-1])
    return out


def word_units(word: str, before: str, marks: re.Pattern = MARKS_AFTER_WORD) -> list[str]:
    """A word, perhaps with the space before it, and the marks after it."""
    cut = marks.match(word)
    return [before + cut[1], cut[2]] if cut else [before + word]


class UnitEncoder:
    """Encodes texts; ``encode_units`` gives one bytes object per unit of a list.

    ``spaced``: a space before a word is part of its token, as in byte-level
    vocabularies. Otherwise white space only separates. The memory of units is emptied
    when it holds ``max_units``.
    """

    def __init__(
        self,
        encode_units: Callable[[list[str]], list[bytes]],
        spaced: bool,
        max_units: int = MAX_UNITS,
    ):
        self.encode_units = encode_units
        self.spaced = spaced
        self.max_units = max_units
        self.units: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The encoded bytes of each text, null as an empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), _large(""))
        odd = pc.match_substring_regex(texts, ODD)
        regular = pc.if_else(odd, _large(""), texts)
        if self.spaced:
            lined = pc.replace_substring(regular, "\n", " " + LINE)
            lists = pc.split_pattern(pc.binary_join_element_wise(_large(START), lined, _large("")), " ")
        else:
            lists = pc.utf8_split_whitespace(regular)
        coded = lists.flatten().dictionary_encode()
        distinct, codes = _strings(coded.dictionary), coded.indices
        begins = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        apart = odd.to_numpy(zero_copy_only=False).copy()
        if self.spaced:
            loose = _loose(coded.dictionary)
            if loose.any():
                apart |= np.add.reduceat(loose[np.asarray(codes)], begins[:-1]) > 0
        ids = self._ids(coded.dictionary, distinct)
        joined = ids.take(codes)
        ends = np.frombuffer(joined.buffers()[1], "<i8")[: len(joined) + 1]
        data = joined.buffers()[2].to_pybytes() if joined.buffers()[2] else b""
        cuts = ends[begins].tolist()
        out = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        for i in np.flatnonzero(apart).tolist():
            text = texts[i].as_py()
            units = [text] if odd[i].as_py() or not self.spaced else spaced_units(text)
            self._learn_units(units)
            out[i] = b"".join(map(self.units.__getitem__, units))
        return out

    def _ids(self, parts: pa.Array, names: list[str]) -> pa.Array:
        """The encoded bytes of each of the different ``parts``, whose texts are ``names``."""
        if len(self.units) + len(self.parts) > self.max_units:
            self.units.clear()
            self.parts.clear()
        found = list(map(self.parts.get, names))
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            learned = self._encode_parts(parts.take(pa.array(new)))
            for i, ids in zip(new, learned, strict=True):
                found[i] = ids
            self.parts.update(zip(map(names.__getitem__, new), learned, strict=True))
        return pa.array(found, type=pa.large_binary())

    def _encode_parts(self, parts: pa.Array) -> list[bytes]:
        """The encoded bytes of parts: words in one go, others unit by unit."""
        words, heads = parts, [" " if self.spaced else ""] * len(parts)
        lines: list[int] = []
        if self.spaced:  # no space before the first word of a text or line
            words = pc.replace_substring_regex(parts, f"^[{START}{LINE}]", "")
            for i in np.flatnonzero(np.asarray(pc.starts_with(parts, START))).tolist():
                heads[i] = ""
            lines = np.flatnonzero(np.asarray(pc.starts_with(parts, LINE))).tolist()
            for i in lines:
                heads[i] = ""
        whole = pc.match_substring_regex(words, WHOLE_WORD)
        bare = pc.utf8_rtrim(words, characters=MARKS)
        # A word that is nothing but marks, or ends otherwise before them, is not cut.
        cut = pc.and_(whole, pc.match_substring_regex(bare, PLAIN_END[self.spaced]))
        bare = _strings(pc.if_else(cut, bare, words))
        names = _strings(words)
        tails = [name[len(word) :] for name, word in zip(names, bare, strict=True)]
        units = [head + word for head, word in zip(heads, bare, strict=True)]
        others = {i: self._units_of(parts[i].as_py()) for i in np.flatnonzero(~np.asarray(whole)).tolist()}
        for i in others:
            units[i] = tails[i] = ""
        self._learn_units([*units, *set(tails), "\n", *(u for part in others.values() for u in part)])
        known = self.units
        out = [known[u] + known[t] if t else known[u] for u, t in zip(units, tails, strict=True)]
        for i in lines:
            out[i] = known["\n"] + out[i]
        for i, part in others.items():
            out[i] = b"".join(map(known.__getitem__, part))
        return out

    def _learn_units(self, units: list[str]) -> None:
        missing = list(dict.fromkeys(u for u in units if u not in self.units))
        if missing:
            self.units.update(zip(missing, self.encode_units(missing), strict=True))

    def _units_of(self, part: str) -> list[str]:
        if not self.spaced:
            return word_units(part, "", MARKS_AFTER_PLAIN) if part else []
        if part[:1] == START:
            return spaced_units(part[1:])
        if part[:1] == LINE:
            return ["\n", *spaced_units(part[1:])]
        return spaced_units(" " + part)


def _loose(parts: pa.Array) -> np.ndarray:
    """Parts with white space at an end: their cut depends on what stands beside them."""
    inside = pc.and_(
        pc.equal(parts, pc.utf8_trim_whitespace(parts)), pc.not_equal(parts, _large(""))
    )
    return ~inside.to_numpy(zero_copy_only=False) | pc.match_substring_regex(
        parts, "^" + LOOSE_LINE
    ).to_numpy(zero_copy_only=False)
