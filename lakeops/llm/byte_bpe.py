"""Token ids of texts by the tokenizers library's byte-level BPE, at the speed a whole corpus needs.

Byte-level BPE never merges over the edge between a word and the white space that begins the next, so texts are cut
there and each unit's ids are computed once by the library and remembered, up to `REMEMBERED` units. Most texts can be cut
at single spaces and line feeds alone; texts with other white space, or runs of it, are cut by the vocabulary's own rule for white
space. Texts that name a special token are left to the library as they are.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECE = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
ODD = re.compile("[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Marks other than an apostrophe around letters or around digits.
SIMPLE = re.compile(r"( ?[!-&(-/:-@\[-`{-~]*)(\w*?)([!-&(-/:-@\[-`{-~]*)")
REMEMBERED = 900_000


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


def has_rare_gaps(text: str) -> bool:
    """Is there white space that is not a single space, or one or two line feeds, between words?"""
    if "  " in text or " \n" in text or "\n\n\n" in text or "\n\n " in text or text.endswith((" ", "\n\n")):
        return True
    if text.isascii():  # looking for one character after another is faster than a pattern
        return any(c in text for c in "\t\v\f\r\x1c\x1d\x1e\x1f")
    return ODD.search(text) is not None


def spaced(text: str) -> str:
    """A text without rare gaps as its units between spaces: ` word` is written `word`, a word after a line feed with that
    before it, and a word with nothing before it with a line feed behind."""
    text = text.replace("\n", " \n")
    if text[0] == " ":
        return text[1:]
    first, gap, others = text.partition(" ")
    return f"{first}\n{gap}{others}"


def units_of(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different units of some texts, which of them each unit is, and how many units each text has.

    In texts with rare gaps, pieces of text and of white space follow a tab.
    """
    odd = np.array([t != "" and has_rare_gaps(t) for t in texts], bool)
    usual = pc.split_pattern(pa.array([spaced(t) for t, o in zip(texts, odd.tolist(), strict=True) if t and not o], pa.large_string()), " ")
    others = [["\t" + piece for piece in PIECE.findall(texts[k])] for k in np.flatnonzero(odd).tolist()]
    units = pa.chunked_array([usual.flatten(), pa.array(list(chain.from_iterable(others)), pa.large_string())]).combine_chunks()
    coded = units.dictionary_encode()
    different, which = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
    counts = np.zeros(len(texts), np.int64)
    some = np.array([t != "" for t in texts], bool)
    counts[some & ~odd] = np.diff(usual.offsets.to_numpy())
    counts[odd] = [len(x) for x in others]
    if others:  # they stand behind the others: back to the order of the texts
        order = np.argsort(odd, kind="stable")
        first = np.empty(len(texts), np.int64)
        first[order] = np.cumsum(counts[order]) - counts[order]
        which = which[np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(len(which))]
    return different, which, counts


def written(unit: str) -> list[str]:
    """The pieces of text a unit stands for."""
    if unit[:1] == "\t":
        return [unit[1:]]
    if unit[:1] == "\n":
        return ["\n", unit[1:]] if len(unit) > 1 else ["\n"]
    return [unit[:-1]] if unit[-1:] == "\n" else [" " + unit]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.first, self.size = array("I"), array("q"), array("i")

    def parts(self, unit: str) -> list[str] | None:
        """What the vocabulary's pattern cuts a unit into, in byte letters; None if that is left to the library."""
        found, ascii_, space = [], unit.isascii(), self.letters[32]
        if ascii_ and unit[:-1].isalpha() and unit[-1] in ",.;:!?-)":  # a space, a word and a mark
            return [space + unit[:-1], unit[-1]]
        for piece in written(unit):
            parts = SIMPLE.fullmatch(piece)
            if not parts:
                return None
            before, middle, after = parts.groups()
            if middle and not (middle.isalpha() or middle.isdecimal()):
                return None
            for part in (before, middle, after) if before and before != " " else (before + middle, after):
                if part:
                    found.append(part.replace(" ", space) if ascii_ and part.isprintable() else part.encode().decode("latin1").translate(self.letters))
        return found

    def learn(self, units: list[str]) -> None:
        """Ids of units not known yet, all different."""
        tokenize, space, marks = self.model.tokenize, self.letters[32], {}
        ids, sizes = array("I"), array("i")
        for unit in units:
            if unit.isascii() and unit.isalpha():  # the usual case: a space and a word
                mine = [t.id for t in tokenize(space + unit)]
            elif (parts := self.parts(unit)) is None:
                mine = [i for piece in written(unit) for i in self.tokenizer.encode(piece, add_special_tokens=False).ids]
            else:
                mine = []
                for part in parts:
                    if len(part) > 2:
                        mine += [t.id for t in tokenize(part)]
                    elif part in marks:
                        mine += marks[part]
                    else:
                        marks[part] = [t.id for t in tokenize(part)]
                        mine += marks[part]
            ids.extend(mine)
            sizes.append(len(mine))
        self.place.update(zip(units, range(len(self.size), len(self.size) + len(units)), strict=True))
        self.first.extend(accumulate(sizes[:-1], initial=len(self.flat)) if sizes else ())
        self.size.extend(sizes)
        self.flat.extend(ids)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, as the library gives them without special tokens; and how many each has."""
        alone = {k for k, t in enumerate(texts) if any(s in t for s in self.special)}
        units, which, numbers = units_of(["" if k in alone else t for k, t in enumerate(texts)] if alone else texts)
        if len(self.place) > REMEMBERED:
            self.forget()
        code = np.fromiter(map(self.place.get, units, repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(code < 0)
        if len(new):
            names = [units[k] for k in new.tolist()]
            code[new] = len(self.place) + np.arange(len(new))
            self.learn(names)
        flat, first, size = (np.frombuffer(x, k) if len(x) else np.empty(0, k) for x, k in ((self.flat, np.uint32), (self.first, np.int64), (self.size, np.int32)))
        first, sizes = first[code][which], size[code].astype(np.int64)[which]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        del flat, first, size  # the arrays grow again only when nothing looks at them
        total = np.concatenate([[0], ends])
        edges = total[np.concatenate([[0], np.cumsum(numbers)]).astype(np.int64)]
        counts = np.diff(edges)
        if not alone:
            return ids, counts
        parts = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) if k in alone else ids[edges[k] : edges[k + 1]] for k, t in enumerate(texts)]
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
