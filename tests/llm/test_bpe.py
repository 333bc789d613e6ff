import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from keelson.llm import bpe
from tests.llm.helpers import LONG, awkward, empty


@pytest.fixture(scope="module")
def pair():
    library = Tokenizer.from_file(bpe.default_path())
    library.no_truncation()
    library.no_padding()
    return bpe.WordBpe(bpe.load(bpe.default_path())), library


def same(pair, text):
    own, library = pair
    ids = np.frombuffer(own.encode(text), dtype="<u4").tolist()
    wanted = library.encode(text, add_special_tokens=False).ids
    assert ids == wanted
    assert own.decode(ids) == library.decode(wanted, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", " \n\t", "Hello, WORLD!! it's don't I'LL", "ΑΣΣ ΟΔΟΣ İstanbul ẞ", "a\x1cb\x85c　d​e",
    "x<|startoftext|>y<|endoftext|> <|other|>", "日本語 テキスト ½²Ⅷ 123", "e\u0301 cafe\u0301 ﬁ",
    "🙂🙂👩‍👩‍👧 __x_", "a" * 5000, "'s's't", LONG[:100_000]])
def test_as_the_library(pair, text):
    same(pair, text)


def test_as_the_library_on_random_texts(pair):
    rng = random.Random(4)
    letters = "aábΣσİ'sdtmlr!?_ \n\t　１२½漢字éè\u0301🙂<|>ßñü0.,"
    for _ in range(300):
        same(pair, "".join(rng.choice(letters) for _ in range(120)))


def test_merging_one_long_word_is_not_quadratic(pair):
    own, _ = pair
    assert len(own.encode("ab" * 200_000)) > 0


def test_word_cache_is_bounded():
    own = bpe.WordBpe(bpe.load(bpe.default_path()), limit=3)
    first = own.encode("one two three four five six")
    assert len(own) <= 3 and own.encode("one two three four five six") == first


def test_documents(spark, pair):
    out = bpe.encode_documents(awkward(spark), ids=True).collect()
    texts = [r["text"] for r in awkward(spark).collect()]
    assert len(out) == len(texts)
    _, library = pair
    for row, text in zip(out, texts, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(row["decoded"].encode()).hexdigest()
    assert bpe.encode_documents(empty(spark)).count() == 0
