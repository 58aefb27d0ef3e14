"""Token ids of whole texts by the tokenizers library, which sees each distinct piece of text only once."""

from __future__ import annotations

import gc
import os
import re
from collections import Counter
from functools import lru_cache
from itertools import chain, compress, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space of Unicode: no token of the two pre-tokenizers has white space behind another character.
SPACE = "\t-\r \x85\xa0  -     　"
SPACED = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
# What keeps a text from being cut at its blanks and line breaks: runs of them, other white space (also what only
# Python takes for it), the mark below.
RUNS = ("  ", "\n ", " \n", "\n\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x00")
WIDE = re.compile("[^\\S \n]")
# Letters with one lower case in every library and no composition; punctuation without apostrophes and special tokens.
LETTER, MARK = "[A-Za-zÀ-ÖØ-öø-ÿ]", "[!-&(-/:;=>?@[-`{}~]"
PLAIN = re.compile(f"(?: ?{LETTER}+{MARK}*|\n)(?:{LETTER}+{MARK}*)*")
PARTS = re.compile(f" ?{LETTER}+|{MARK}+|\n")
# Marks a piece that is not behind a blank; texts with this character are cut in another way.
BARE = "\x00"
# Pieces held per worker; beyond it only those stay that the last texts repeat.
HELD_PIECES = 150_000
# Parts of Latin texts held per worker, about 200 bytes each; beyond it those used most stay, at most half of them.
HELD_PARTS = 500_000
# What a byte of UTF-8 is. A text with foreign bytes (control characters, letters beyond Latin-1) is cut in another way.
OTHER, WORD, SIGN, BLANK, LINE, FOREIGN = range(6)
KINDS = np.full(256, FOREIGN, np.uint8)
KINDS[33:128] = OTHER
KINDS[[b for b in range(128) if re.match("[A-Za-z]", chr(b))]] = WORD
KINDS[[b for b in range(128) if re.match(MARK, chr(b))]] = SIGN
KINDS[32], KINDS[10] = BLANK, LINE
# First byte of U+00C0 to U+00FF, and the second bytes of the two signs among these letters.
LATIN, LATIN_SIGNS = 0xC3, (0x97, 0xB7)


def byte_letters() -> dict[int, str]:
    """The printable stand-ins of byte-level models: printable Latin-1 stays, other bytes follow from U+0100."""
    stays = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in stays]
    return {b: chr(b) for b in stays} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def shared_encoder(path: str, keeps_space: bool) -> Encoder:
    """The encoder of a worker process: what it has learned serves all tasks that run there."""
    return Encoder(path, keeps_space)


class Encoder:
    """Encodes texts piece by piece with a memory of pieces; the ids are those of the whole text.

    ``keeps_space`` tells whether tokens take the white space before them (byte-level model) or white
    space is dropped and case folded (word model). Texts are cut only before white space that follows
    another character, where both pre-tokenizers cut. Plain words go straight to the model; whatever
    has other characters goes through the library's whole chain, special tokens included. Texts of
    ASCII and Latin-1 letters are cut and looked up as arrays of bytes, a whole column at once; others
    one after another.
    """

    def __init__(self, path: str, keeps_space: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.keeps_space = keeps_space
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items() if b})
        self.held: dict[str | bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        # Code points of the stand-ins; the word model's have no white space.
        self.signs = np.array([ord(c) if b else 0 for b, c in sorted(byte_letters().items())], "<u4")
        # Parts by number, in the order of the dictionary; ids of part k: size[k] of them from first[k] on.
        self.numbers: dict[bytes, int] = {}
        self.ids, self.first, self.size, self.uses = np.zeros(0, "<u4"), *(np.zeros(0, np.int64) for _ in range(3))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids (uint32) of each text; null has none."""
        return self.encode_column(pa.array(texts, pa.string()))

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids (uint32) of each text of a column; null has none."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not len(texts):
            return []
        _, ends, data = texts.buffers()
        ends = np.frombuffer(ends, np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
        data = np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]
        ends -= ends[0]
        kinds = KINDS[data]
        lead = np.flatnonzero(data[:-1] == LATIN)
        second = data[lead + 1]
        # Continuation bytes alone follow a first byte; anything else stays foreign.
        lead, second = lead[second & 0xC0 == 0x80], second[second & 0xC0 == 0x80]
        kinds[lead] = kinds[lead + 1] = np.where(np.isin(second, LATIN_SIGNS), OTHER, WORD)
        sizes, foreign = np.diff(ends), np.zeros(len(texts), bool)
        foreign[np.searchsorted(ends, np.flatnonzero(kinds == FOREIGN), side="right") - 1] = True
        if foreign.any():
            keep = np.repeat(~foreign, sizes)
            data, kinds, sizes = data[keep], kinds[keep], np.where(foreign, 0, sizes)
        out = self.encode_latin(data, kinds, sizes)
        if foreign.any():
            rest = np.flatnonzero(foreign)
            for i, ids in zip(rest, self.encode_foreign(texts.take(pa.array(rest)).to_pylist())):
                out[i] = ids
        return out

    def encode_latin(self, data: np.ndarray, kinds: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Ids of texts that lie behind each other in ``data``.

        Their parts are letters or signs with the blank before them, and line breaks; a stretch between
        white space that holds something else, or has more than one white space before it, is one part.
        """
        if not len(data):
            return [np.zeros(0, "<u4") for _ in sizes]
        ends = np.cumsum(sizes)
        opens = np.zeros(len(data), bool)
        opens[(ends - sizes)[sizes > 0]] = True
        before = np.empty_like(kinds)
        before[0], before[1:] = OTHER, kinds[:-1]
        space, late = kinds >= BLANK, (before >= BLANK) & ~opens
        fresh = opens | (space & ~late)
        units = np.flatnonzero(fresh)
        odd = np.zeros(len(units), bool)
        odd[np.searchsorted(units, np.flatnonzero((kinds == OTHER) | (space & late)), side="right") - 1] = True
        within = np.repeat(odd, np.diff(units, append=len(data)))
        starts = np.flatnonzero(fresh | (~within & (kinds != before) & (before != BLANK)))
        if not self.keeps_space:
            data = self.lower(data, kinds, ~within)
        borders = np.append(starts, len(data)).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        part, names = found.indices.to_numpy(), found.dictionary.to_numpy(zero_copy_only=False).tolist()
        whole = np.zeros(len(names), bool)
        whole[part[within[starts]]] = True
        number = np.fromiter(map(self.numbers.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = self.learn_parts([names[i] for i in new.tolist()], whole[new])
        self.uses[number] += np.bincount(part, minlength=len(names))
        number = number[part]
        size = self.size[number]
        upto = np.cumsum(size)
        ids = self.ids[np.repeat(self.first[number] - (upto - size), size) + np.arange(upto[-1])]
        if len(self.numbers) > HELD_PARTS:
            self.forget()
        ends = np.append(0, upto)[np.searchsorted(starts, ends)].tolist()
        return [ids[a:b] for a, b in pairwise([0, *ends])]

    @staticmethod
    def lower(data: np.ndarray, kinds: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Letters in lower case; those of parts for the whole chain stay, as it folds them after finding special tokens."""
        large = (kinds == WORD) & where & (((data >= 65) & (data <= 90)) | ((data >= 0x80) & (data <= 0x9E)))
        return data + (large.view(np.uint8) << 5)

    def learn_parts(self, names: list[bytes], whole: np.ndarray) -> np.ndarray:
        """Numbers of new parts; those that are ``whole`` go through the library's whole chain."""
        plain = b"\0".join(compress(names, ~whole))
        if not self.keeps_space:
            plain = plain.translate(None, b" \n")
        seen = self.signs[np.frombuffer(plain, np.uint8)].tobytes().decode("utf-32-le").split("\0") if not whole.all() else []
        lists: list[list[int]] = [[]] * len(names)
        tokenize = self.whole.model.tokenize
        # Many small objects are made and dropped at once, none of them in cycles.
        gc.disable()
        try:
            for i, text in zip(np.flatnonzero(~whole).tolist(), seen):
                lists[i] = [t.id for t in tokenize(text)]
            odd = self.whole.encode_batch_fast([name.decode() for name in compress(names, whole)], add_special_tokens=False)
            for i, e in zip(np.flatnonzero(whole).tolist(), odd):
                lists[i] = e.ids
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter(chain.from_iterable(lists), "<u4", int(size.sum()))
        finally:
            gc.enable()
        number = len(self.numbers) + np.arange(len(names))
        self.numbers.update(zip(names, number.tolist()))
        self.first = np.append(self.first, len(self.ids) + np.cumsum(size) - size)
        self.ids, self.size = np.append(self.ids, ids), np.append(self.size, size)
        self.uses = np.append(self.uses, np.zeros(len(names), np.int64))
        return number

    def forget(self) -> None:
        """Keep the parts used most, and more than once; earlier uses count half from now on."""
        least = max(2, np.partition(self.uses, -(HELD_PARTS // 2))[-(HELD_PARTS // 2)] + 1)
        keep = self.uses >= least
        self.numbers = {name: i for i, name in enumerate(compress(self.numbers, keep))}
        self.ids = self.ids[np.repeat(keep, self.size)]
        self.size, self.uses = self.size[keep], self.uses[keep] // 2
        self.first = np.cumsum(self.size) - self.size

    def units(self, text: str) -> list:
        """Pieces of a text: of a byte-level model without the blank before them, unless marked as bare."""
        if not self.keeps_space:
            return text.encode().split()
        if any(run in text for run in RUNS) or (not text.isascii() and WIDE.search(text)):
            return [BARE + u for u in SPACED.findall(text)]
        out: list[str] = []
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(BARE + "\n")
            first, *rest = line.split(" ")
            if first:
                out.append(BARE + first)
            out += rest
        return out

    def text_of(self, unit: str | bytes) -> str:
        if not self.keeps_space:
            return unit.decode()
        return unit[1:] if unit[:1] == BARE else " " + unit

    def encode_foreign(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts with other than Latin letters, or with control characters."""
        units: list = []
        ends = []
        for text in texts:
            units += self.units(text)
            ends.append(len(units))
        found = list(map(self.held.get, units))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            if len(self.parts) > HELD_PIECES:
                self.parts = {}
            lacking = [units[i] for i in missing]
            # Many small lists are made and dropped at once, none of them in cycles.
            gc.disable()
            try:
                known = self.learn(set(lacking))
            finally:
                gc.enable()
            for i, ids in zip(missing, map(known.__getitem__, lacking)):
                found[i] = ids
            if len(self.held) > HELD_PIECES:
                self.held = {unit: self.held[unit] for unit, n in Counter(units).items() if n > 1}
        return [np.frombuffer(b"".join(found[a:b]), "<u4") for a, b in zip([0, *ends], ends)]

    def learn(self, units: set) -> dict:
        """Ids of new units; kept for later texts."""
        plain, other = {}, []
        for unit in units:
            text = self.text_of(unit)
            if PLAIN.fullmatch(text):
                plain[unit] = PARTS.findall(text if self.keeps_space else text.lower())
            else:
                other.append((unit, text))
        new = [p for p in set(chain.from_iterable(plain.values())) if p not in self.parts]
        # The model alone sees bytes as their stand-ins, which make up all of a part but keep the joining zero byte.
        seen = BARE.join(new).encode().decode("latin-1").translate(self.letters).split(BARE) if new else []
        tokenize = self.whole.model.tokenize
        self.parts |= zip(new, self.packed([[t.id for t in tokenize(p)] for p in seen]))
        out = {unit: b"".join(map(self.parts.__getitem__, parts)) for unit, parts in plain.items()}
        whole = self.whole.encode_batch_fast([text for _, text in other], add_special_tokens=False)
        out |= zip((unit for unit, _ in other), self.packed([e.ids for e in whole]))
        self.held |= out
        return out

    @staticmethod
    def packed(lists: list[list[int]]) -> list[bytes]:
        """Little-endian 32-bit ids of each list."""
        ends = np.cumsum([0, *map(len, lists)]).tolist()
        data = np.fromiter(chain.from_iterable(lists), "<u4", ends[-1]).tobytes()
        return [data[4 * a:4 * b] for a, b in pairwise(ends)]
