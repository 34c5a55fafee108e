"""Pieces of text, cut and encoded many at a time."""

import numpy as np
import pytest

from loadlake.llm import id_files, packing, token_counts
from loadlake.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER, tokenizer_path


class Told:
    """A tokenizer that notes the texts it gets."""

    def __init__(self, inner):
        self.inner, self.texts = inner, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.inner.encode_batch_fast(texts, **options)


@pytest.mark.parametrize(("name", "lead"), [(WORD_TOKENIZER, ""), (BYTE_TOKENIZER, " ")])
def test_plain_words_are_encoded_once_and_not_normalised(name, lead):
    from tokenizers import Tokenizer

    path = tokenizer_path(name)
    encoder, whole = packing.PieceEncoder(path, lead=lead), Tokenizer.from_file(path)
    encoder.tokenizer, encoder.bare = Told(encoder.tokenizer), Told(encoder.bare)
    texts = ["", "a straße, a straße. A déjà\nvu; straße!", "- straße (déjà) été 12 straße", " \n", "", "x y　z\x85 w"]
    for _ in range(2):
        for text, ids in zip(texts, encoder.ids(encoder.cut(texts)), strict=True):
            assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text
    words = "".join(encoder.bare.texts).split(" ")
    assert words.count("straße") == 1 and not any("straße" in t for t in encoder.tokenizer.texts)


def test_chunks_are_those_of_the_pattern():
    rng = np.random.default_rng(3)
    some = [*"ab.\n\t \x1c\x1f\x85\xa0é  ​   　、Â漢"]
    texts = ["".join(rng.choice(some, rng.integers(0, 12))) for _ in range(3000)]
    pieces = packing.PieceEncoder(tokenizer_path(BYTE_TOKENIZER), lead=" ").cut(texts)
    strings = pieces.strings.to_pylist()
    for text, a, b in zip(texts, pieces.firsts[:-1], pieces.firsts[1:], strict=True):
        assert strings[a:b] == token_counts._CHUNK.findall(text)


def test_long_texts_are_encoded_in_parts(monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer_path(BYTE_TOKENIZER)
    whole = Tokenizer.from_file(path)
    monkeypatch.setattr(id_files, "CHARS_AT_ONCE", 40)
    texts = ["some words " * 30, "", "short", "x" * 100, "a b", " y" * 60]
    found = list(id_files.token_ids(texts, packing.PieceEncoder(path, lead=" ")))
    assert [x.tolist() for x in found] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
