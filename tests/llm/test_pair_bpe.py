import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pixelflow.llm import pair_bpe as B

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)

    def both(text):
        ids = t.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)
    return both


def test_random_texts_match_the_library(reference):
    r = random.Random(5)
    pool = [chr(c) for c in [*range(0, 0x250), *range(0x300, 0x500), *range(0x2000, 0x2070), 0x3000, 0xFEFF, 0x1F600, 0xAC00, 0x1100,
                             0x1161, 0x958, 0x2126, 0x212B, 0x4E00, 0x660, 0xBD, 0x2160]]
    pool += ["<|endoftext|>", "<|STARTOFTEXT|>", "<|", "'s", "'LL", " ", "the", "ing"] * 8
    e = B.Encoder(PATH)
    for _ in range(1500):
        text = "".join(r.choice(pool) for _ in range(r.randint(0, 60)))
        ids = e.encode([text])[0]
        assert (ids, e.decode(ids)) == reference(text), ascii(text)
    for _ in range(200):
        text = "".join(r.choice("abeinorst") for _ in range(r.randint(0, 400)))
        assert e.encode([text])[0] == reference(text)[0]


def test_memo_never_changes_results(reference, monkeypatch):
    monkeypatch.setattr(B, "MEMO_WORDS", 3)
    e, texts = B.Encoder(PATH), ["one two three four", "two three five", "<|endoftext|> one", "six one two"]
    for _ in range(3):
        assert e.encode(texts, block=1) == [reference(t)[0] for t in texts]


def test_odd_rows(odd, none, clashing, reference):
    rows = B.decode(B.encode(odd, PATH, ("doc_id", "text")), PATH, ("doc_id", "text")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        ids, text = reference(r.text or "")
        assert bytes(r.ids) == ids and hashlib.sha256(r.decoded.encode()).digest() == hashlib.sha256(text.encode()).digest()
    keep = ("doc_id", "text")
    assert sorted(map(str, B.round_trip(odd, PATH, keep).collect())) == sorted(map(str, B.decode(B.encode(odd, PATH, keep), PATH, keep).collect()))
    assert B.decode(B.encode(none, PATH), PATH).count() == 0 and B.round_trip(none, PATH).count() == 0
    assert B.encode(clashing, PATH).count() == odd.count()


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        B.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def test_a_word_of_several_chunks_is_merged_once(reference, monkeypatch):
    e, seen, merge = B.Encoder(PATH), [], B.merge_words
    monkeypatch.setattr(B, "merge_words", lambda v, words: seen.extend(words) or merge(v, words))
    texts = ["Anwhtion sttible", "anwhtion, (sttible)", "anwhtion. it's sttible", "anwhtion"]
    assert e.encode(texts, block=1) == [reference(t)[0] for t in texts]
    assert len(seen) == len(set(seen)) and {b"anwhtion", b"sttible", b"'s"} <= set(seen)
