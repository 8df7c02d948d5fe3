"""The cached encoder against the library on whole texts."""

import sys

import numpy as np
import pyarrow as pa
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from pixelweave.llm.text import Encoder, few_texts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)

TEXTS = [
    "", "İstanbul ISTANBUL ıI ſs ŉ ǅ Ⱥ", "Σίσυφος ΣΑΣ", "é é ångström", "ǆ Ǆ ǅ", "naïve Ünïcödé ÿŸ",
    "word.Word Word's 'Tis they'LL", "ﬁ ﬂ Ａ ① ² ½", "x" * 3000, "Æther ŒUVRE ß ẞ", "日本 한국 ру",
]


def same(texts):
    got = [np.frombuffer(ids, "<u4").tolist() for ids in Encoder(PATH).encode(texts)]
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_odd_letters():
    same(TEXTS)
    same(TEXTS[::-1])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", max_codepoint=0x24F), max_size=20), max_size=4))
def test_latin_texts(texts):
    same(texts)


def test_a_worker_keeps_a_bounded_cache():
    """The pipeline's workers hold few words, whatever they encoded, and the ids are the same."""
    column = pa.array([None, *(f"word{i} Word{i}! {i}" for i in range(3_000))])
    expected = list(Encoder(PATH).encode_column(column))
    sys.modules.pop("_word_ids")
    bounded = Encoder(PATH, cached=2_000)
    assert list(bounded.encode_column(column)) == expected and expected[0] == b""
    # The bound, and what one part of 500 texts adds.
    assert len(sys.modules["_word_ids"].words) <= 2_000 + 500 * 5
    sys.modules.pop("_word_ids")


def test_few_texts_of_a_batch_at_a_time():
    column = pa.array(["a", None, "b", "c", None]).slice(1)
    assert list(few_texts(column, 3)) == [["", "b", "c"], [""]]
    assert list(few_texts(column.slice(4))) == []
