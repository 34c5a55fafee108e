"""Token ids of short pieces of text, each different piece encoded once per task.

Texts are cut where the tokenizer's pre-tokens part for certain; the cuts, the different pieces among them and the ids of
all texts of a call are found in Arrow and numpy. A piece of letters is one pre-token, and so is a run of ASCII
punctuation behind it; letter runs are encoded many at a time in one text and told apart by the tokens that end (or begin)
a word. Everything else is encoded by itself. Letter runs that the tokenizer's normalising would leave alone skip it.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loadlake.llm.common import give_back

KNOWN_PIECES = 600_000
TOGETHER = 1000
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters of which each is one code point in every normal form.
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: White space as the tokenizers' pre-token patterns have it, and its forms of several bytes.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[*range(9, 14), 32]] = True
_WIDE_SPACE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_LEADS = sorted({c[0] for c in _WIDE_SPACE})


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all stretches, one after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


def white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 belong to white space."""
    space = _ASCII_SPACE[data]
    for lead in _LEADS:
        at = np.flatnonzero(data == lead)
        for form in _WIDE_SPACE if len(at) else ():
            if form[0] == lead:
                found = at[at + len(form) <= len(data)]
                for k in range(1, len(form)):
                    found = found[data[found + k] == form[k]]
                for k in range(len(form)):
                    space[found + k] = True
    return space


def longer(array: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
    """The array with ``new`` behind its first ``used`` places; it grows by doubling."""
    if used + len(new) > len(array):
        array = np.concatenate([array[:used], np.zeros(used + len(new), array.dtype)])
    array[used : used + len(new)] = new
    return array


class Pieces:
    """Texts cut into pieces: ``bounds`` of all pieces in the bytes ``data``, and each text's first piece."""

    def __init__(self, texts: list[str], lead: str):
        joined = pa.array(texts, pa.string())
        offsets = np.frombuffer(joined.buffers()[1], np.int32)[: len(texts) + 1]
        self.data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[: offsets[-1]]
        if lead:
            space = white_space(self.data)
        else:  # only spaces and line ends part pieces, as spaces
            self.data = np.where(self.data == 10, np.uint8(32), self.data)
            space = self.data == 32
        begins = np.zeros(len(self.data) + 1, bool)
        begins[1:-1] = space[1:] & ~space[:-1]
        begins[offsets] = True
        self.bounds = np.flatnonzero(begins).astype(np.int32)
        self.firsts = np.searchsorted(self.bounds, offsets)
        self.strings = pa.StringArray.from_buffers(len(self.bounds) - 1, pa.py_buffer(self.bounds), pa.py_buffer(self.data))


class PieceEncoder:
    """``cut`` parts texts into pieces; ``ids`` and ``counts`` give their ids.

    ``lead`` is what separates words in the tokenizer's own view: "" for one that drops white space and marks word ends,
    " " for a byte-level one, whose pieces bring the space before a word along.
    """

    def __init__(self, path: str, lead: str, encode_special_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.tokenizer.encode_special_tokens = encode_special_tokens
        self.lead = lead
        self.bare = Tokenizer(self.tokenizer.model)  # the same model, for words that need no normalising
        self.bare.normalizer = normalizers.Sequence([])
        parted = pre_tokenizers.Split(" ", "merged_with_next" if lead else "removed")
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([parted, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.edge[i] = token.startswith("Ġ") if lead else token.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {"": 0}
        self.flat, self.n_ids = np.zeros(0, "<u4"), 0
        self.starts = np.zeros(1, np.int64)
        self.lengths = np.zeros(1, np.int64)

    def close(self) -> None:
        """At a task's end: what the tokenizer and the known pieces took goes back to the system."""
        self.clear()
        self.tokenizer = self.bare = None
        give_back()

    def cut(self, texts: list[str]) -> Pieces:
        return Pieces(texts, self.lead)

    def ids(self, pieces: Pieces) -> list[np.ndarray]:
        """The ids of each text."""
        codes, head, tail = self._known(pieces.strings)
        heads, lengths = self.lengths[head], self.lengths[head] + self.lengths[tail]
        starts = np.cumsum(lengths) - lengths
        own = np.zeros(int(lengths.sum()), "<u4")
        own[spread(starts, heads)] = self.flat[spread(self.starts[head], heads)]
        own[spread(starts + heads, self.lengths[tail])] = self.flat[spread(self.starts[tail], self.lengths[tail])]
        all_ids = own[spread(starts[codes], lengths[codes])]
        ends = np.r_[0, np.cumsum(lengths[codes])][pieces.firsts].tolist()
        return [all_ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def counts(self, strings: pa.StringArray) -> np.ndarray:
        """The number of ids of each piece."""
        codes, head, tail = self._known(strings)
        return (self.lengths[head] + self.lengths[tail])[codes]

    def few_counts(self, pieces: list[str]) -> np.ndarray:
        """The number of ids of each of a few pieces, most of which are known."""
        words = [word if self._is_word(word := piece.rstrip(_PUNCTUATION)) else "" for piece in pieces]
        head = np.array([self.number.get(w, -1) for w in words], np.int64)
        tail = np.array([self.number.get(p[len(w) :], -1) for p, w in zip(pieces, words, strict=True)], np.int64)
        out = self.lengths[head] + self.lengths[tail]
        new = np.flatnonzero((head < 0) | (tail < 0))
        if len(new):
            out[new] = self.counts(pa.array([pieces[i] for i in new], pa.string()))
        return out

    def _known(self, strings: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of each piece among the different ones, and the numbers of these's two parts; new parts are encoded.
        Numbers hold until the next call."""
        if len(self.number) > KNOWN_PIECES:
            self.clear()
        coded = strings.dictionary_encode()
        whole = coded.dictionary if self.lead else pc.ascii_ltrim(coded.dictionary, " ")
        word = pc.ascii_rtrim(whole, _PUNCTUATION)
        plain = pc.match_substring_regex(word, f"^{self.lead}[{_LATIN}]+$").to_numpy(zero_copy_only=False)
        other = np.flatnonzero(~(plain | pc.string_is_ascii(word).to_numpy(zero_copy_only=False)))
        wordlike = plain.copy()
        wordlike[other] = [self._is_word(w) for w in word.take(pa.array(other)).to_pylist()]
        no_text = pa.scalar("")
        head = pc.if_else(pa.array(wordlike), word, no_text)
        if not self.lead:
            head = pc.if_else(pa.array(plain), pc.utf8_lower(head), head)
        size, cut = pc.binary_length(whole).to_numpy(), np.where(wordlike, pc.binary_length(word).to_numpy(), 0)
        tail = whole
        if wordlike.any():
            first = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset : whole.offset + len(whole)]
            bytes_ = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[spread(first + cut, size - cut)]
            tail = pa.StringArray.from_buffers(len(whole), pa.py_buffer(np.r_[0, np.cumsum(size - cut)].astype(np.int32)), pa.py_buffer(bytes_))
        return coded.indices.to_numpy(), self._numbers(head, plain), self._numbers(tail, None)

    def _numbers(self, parts: pa.StringArray, plain: np.ndarray | None) -> np.ndarray:
        """The number of each part; ``plain`` of those that are words: whether they need no normalising."""
        coded = parts.dictionary_encode()
        codes = coded.indices.to_numpy()
        keys = coded.dictionary.to_pylist()
        known = [self.number.get(k, -1) for k in keys]
        new = [i for i, n in enumerate(known) if n < 0]
        if new:
            some = [keys[i] for i in new]
            if plain is None:
                ids = self._alone(some)
            else:
                is_plain = np.zeros(len(keys), bool)
                is_plain[codes] = plain
                ids = [b""] * len(new)
                for tokenizer, kind in ((self.bare, is_plain), (self.tokenizer, ~is_plain)):
                    mine = np.flatnonzero(kind[new]).tolist()
                    for k in range(0, len(mine), TOGETHER):
                        places = mine[k : k + TOGETHER]
                        for i, raw in zip(places, self._together([some[i] for i in places], tokenizer), strict=True):
                            ids[i] = raw
            lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            first = len(self.number)
            self.number.update(zip(some, range(first, first + len(some)), strict=True))
            self.starts = longer(self.starts, first, self.n_ids + np.cumsum(lengths) - lengths)
            self.lengths = longer(self.lengths, first, lengths)
            self.flat = longer(self.flat, self.n_ids, np.frombuffer(b"".join(ids), "<u4"))
            self.n_ids += int(lengths.sum())
            known = np.array(known)
            known[new] = np.arange(first, first + len(some))
        return np.asarray(known, np.int64)[codes]

    def _is_word(self, word: str) -> bool:
        """Whether the tokenizer surely sees letters only: also after its own normalising, where it does any."""
        if self.lead:
            return word[:1] == self.lead and word[1:].isalpha()
        return word.isalpha() and unicodedata.normalize("NFC", word).lower().isalpha()

    def _alone(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _together(self, words: list[str], tokenizer) -> list[bytes]:
        text = "".join(words) if self.lead else " ".join(words)
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        edges = np.flatnonzero(self.edge[ids])
        if len(edges) != len(words):  # the tokenizer sees other words here than expected
            return self._alone(words)
        bounds = np.r_[edges, len(ids)] if self.lead else np.r_[0, edges + 1]
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
