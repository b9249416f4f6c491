"""Texts to ids of a public tokenizer, word by word.

Both tokenizers cut a text into pre-tokens before merging, and a merge never crosses a cut. A cut
before a single space (byte BPE) or at white space (word BPE) is always one of theirs, and so is the
one between letters and the signs after them. So each different piece of a slice is encoded once by
the tokenizers library, and the ids of the texts are put together from there. Words seen before come
from a table per Python worker, whose size is bounded.
"""

from __future__ import annotations

import os
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from plumeline.llm.common import Words, ragged, run_sums

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
#: Words that a worker remembers; beyond it new ones are encoded each time they come. Every step looks
#: its words up in all of them, and what they take stays with the worker.
REMEMBERED = 200_000
#: Words joined into one text for the tokenizer.
JOINED = 256
#: Signs cut off a word's end; none of them starts a longer pre-token with letters.
SIGNS = ".,!?:;#$%&*|)"
#: Longest run of signs that is cut off.
MOST_SIGNS = 8


def coder(name: str) -> Coder:
    """The worker's own coder of a tokenizer file, made at first use.

    The package goes to the workers by value, so its globals last for one task; what shall last as
    long as the worker is kept among the interpreter's modules.
    """
    coders = sys.modules.setdefault("_plumeline_coders", types.ModuleType("_plumeline_coders")).__dict__
    if name not in coders:
        coders[name] = Coder(name)
    return coders[name]


class Ids:
    """Runs of ids in one array."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        self.flat, self.lengths = flat, lengths
        self.place = np.cumsum(lengths) - lengths

    @staticmethod
    def of(runs: list[list[int]]) -> Ids:
        lengths = np.fromiter((len(x) for x in runs), np.int64, len(runs))
        return Ids(np.fromiter((i for x in runs for i in x), np.uint16, int(lengths.sum())), lengths)

    @staticmethod
    def joined(parts: list[Ids]) -> Ids:
        return Ids(np.concatenate([p.flat for p in parts]), np.concatenate([p.lengths for p in parts]))

    def take(self, rows: np.ndarray) -> Ids:
        lengths = self.lengths[rows]
        return Ids(self.flat[ragged(self.place[rows], lengths)], lengths)

    def glued(self, counts: np.ndarray) -> Ids:
        """The next counts[i] runs become run i."""
        ends = np.concatenate([[0], np.cumsum(self.lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        return Ids(self.flat, np.diff(ends))


class Coder:
    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.encode_special_tokens = True
        self.spaced = name == BYTE_BPE
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(65536, bool)  # ids that begin with a space
        self.closes = np.zeros(65536, bool)  # ids that end a word
        for token, i in vocabulary.items():
            self.opens[i], self.closes[i] = token.startswith("Ġ"), token.endswith("</w>")
        self.line = vocabulary.get("Ċ")
        self.names = {lead: pa.array([], pa.string()) for lead in (" ", "\n")}
        self.known = {lead: Ids(np.zeros(0, np.uint16), np.zeros(0, np.int64)) for lead in (" ", "\n")}

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str], lead: str) -> Ids:
        """Ids of new words of letters after a space or at a line's start, many in one text."""
        parts = []
        for a in range(0, len(words), JOINED * 64):
            groups = [words[b : b + JOINED] for b in range(a, min(a + JOINED * 64, len(words)), JOINED)]
            for group, ids in zip(groups, self.whole([lead + lead.join(g) for g in groups])):
                ids = np.array(ids, np.uint16)
                if not self.spaced:
                    ends = np.flatnonzero(self.closes[ids]) + 1
                elif lead == " ":
                    ends = np.append(np.flatnonzero(self.opens[ids]), len(ids))[1:]
                else:
                    at = np.flatnonzero(ids == self.line)
                    ends = np.append(at, len(ids))[1:] - np.arange(1, len(at) + 1)
                    ids = np.delete(ids, at)
                if len(ends) == len(group):
                    parts.append(Ids(ids, np.diff(ends, prepend=0)))
                else:  # a letter that becomes several signs when lower-cased
                    one = " " if lead == " " and self.spaced else ""
                    parts.append(Ids.of(self.whole([one + w for w in group])))
        return Ids.joined(parts) if parts else Ids(np.zeros(0, np.uint16), np.zeros(0, np.int64))

    def letters(self, words: pa.StringArray, lead: str) -> Ids:
        """Ids of words of letters, each given once or more often."""
        coded = words.dictionary_encode()
        different = coded.dictionary
        at = pc.index_in(different, value_set=self.names[lead])
        new = different.filter(pc.is_null(at))
        fresh = self._letters(new.to_pylist(), lead)
        base = len(self.names[lead])
        rows = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        rows[rows < 0] = base + np.arange(len(new))
        both = Ids.joined([self.known[lead], fresh])
        if len(new) and base + len(new) <= REMEMBERED:
            self.names[lead] = pa.concat_arrays([self.names[lead], new.cast(pa.string())])
            self.known[lead] = both
        return both.take(rows[coded.indices.to_numpy()])

    def simple(self, words: pa.StringArray, lead: str) -> Ids:
        """Ids of pieces without white space, each after ``lead``."""
        n = len(words)
        head = pc.utf8_rtrim(words, characters=SIGNS)
        signs = (pc.binary_length(words).to_numpy() - pc.binary_length(head).to_numpy()).astype(np.int64)
        plain = pc.utf8_is_alpha(head).to_numpy(zero_copy_only=False) & (signs <= MOST_SIGNS)
        rows = np.flatnonzero(plain)
        parts = [self.letters(head.take(pa.array(rows)), lead)]
        order = [rows * 2]
        for k in np.unique(signs[rows]).tolist():
            if k:
                own = rows[signs[rows] == k]
                tails = pc.utf8_slice_codeunits(words.take(pa.array(own)), -k).dictionary_encode()
                parts.append(Ids.of(self.whole(tails.dictionary.to_pylist())).take(tails.indices.to_numpy()))
                order.append(own * 2 + 1)
        other = np.flatnonzero(~plain)
        before = " " if lead == " " and self.spaced else ""
        parts.append(Ids.of(self.whole([before + w for w in words.take(pa.array(other)).to_pylist()])))
        order.append(other * 2)
        place = np.concatenate(order)
        at = np.argsort(place, kind="stable")
        return Ids.joined(parts).take(at).glued(np.bincount(place // 2, minlength=n))

    def pieces(self, words: pa.StringArray, lead: str) -> Ids:
        """Ids of pieces that hold no white space but single line ends inside."""
        if not self.spaced or len(words) == 0:
            return self.simple(words, lead)
        lines = pc.split_pattern(words, "\n")
        count = np.diff(lines.offsets.to_numpy())
        flat, first = lines.flatten(), lines.offsets.to_numpy()[:-1] - lines.offsets.to_numpy()[0]
        starts = np.zeros(len(flat), bool)
        starts[first] = True
        line = Ids(np.array([self.line], np.uint16), np.ones(1, np.int64))
        heads, rest = self.simple(flat.filter(pa.array(starts)), lead), self.simple(flat.filter(pa.array(~starts)), "\n")
        every = Ids.joined([heads, rest, line])
        rank = np.where(starts, np.cumsum(starts) - 1, len(heads.lengths) + np.cumsum(~starts) - 1)
        # before each later line its line end
        runs = np.ones(len(flat), np.int64) + ~starts
        rows = np.full(int(runs.sum()), len(every.lengths) - 1)
        rows[np.cumsum(runs) - 1] = rank
        return every.take(rows).glued(2 * count - 1)

    def encode(self, text: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray, Words]:
        """Ids of all texts in a row, where each text starts and ends there, and the words.

        ``end`` is put after each text. A null text is empty. All ids are below 65,536.
        """
        text = pc.fill_null(text, "")
        words = Words(text, spaces=self.spaced)
        codes, starts, n = words.codes.astype(np.int64), words.starts, len(words.starts) - 1
        vocabulary, odd = words.vocabulary, np.zeros(n, bool)
        if self.spaced:
            # White space other than one space or line end: such texts are encoded as they are.
            strange = pc.or_(pc.equal(vocabulary, ""), pc.match_substring_regex(vocabulary, r"\s\s|^\s|\s$|[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\pZ]"))
            strange = strange.to_numpy(zero_copy_only=False)
            if strange.any():
                odd = run_sums(strange[words.codes].astype(np.int8), starts) > 0
            clean = pc.if_else(pa.array(strange), "x", vocabulary)
            heads, place = np.unique(codes[starts[:-1][np.diff(starts) > 0]], return_inverse=True)
            # A text's first piece has no space before it.
            table = Ids.joined([self.pieces(clean, " "), self.pieces(clean.take(pa.array(heads)), "\n")])
            codes[starts[:-1][np.diff(starts) > 0]] = len(vocabulary) + place
        else:
            table = self.simple(vocabulary, " ")
        if odd.any():
            rows = np.flatnonzero(odd)
            whole = Ids.of(self.whole(text.take(pa.array(rows)).to_pylist()))
            count = np.diff(starts)
            keep = np.repeat(~odd, count)
            keep[starts[:-1][rows]] = True
            codes[starts[:-1][rows]] = len(table.lengths) + np.arange(len(rows))
            codes, starts = codes[keep], np.concatenate([[0], np.cumsum(np.where(odd, 1, count))])
            table = Ids.joined([table, whole])
        if end is not None:
            codes = np.insert(codes, starts[1:], len(table.lengths))
            starts = starts + np.arange(n + 1)
            table = Ids.joined([table, Ids(np.array([end], np.uint16), np.ones(1, np.int64))])
        ids = table.take(codes)
        return ids.flat, np.concatenate([[0], np.cumsum(ids.lengths)])[starts], words
