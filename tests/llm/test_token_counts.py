import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from tabreg.llm import token_counts as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")


def reference(vocabulary, byte_fallback):
    """The unigram model of `tokenizers` over the same pieces."""
    least = min(vocabulary.pieces.values())
    rest = [(f"<0x{i:02X}>", least) for i in range(256)] if byte_fallback else []
    t = Tokenizer(models.Unigram([("<unk>", least), *rest, *vocabulary.pieces.items()], unk_id=0, byte_fallback=byte_fallback))
    return lambda s: len(t.encode("▁" + s.replace(" ", "▁"), add_special_tokens=False).ids) if s else 0


@pytest.fixture(scope="module")
def public():
    return tc.Vocabulary.of_sentencepiece(PATH)


def test_documents_equal_the_tokenizer(spark, sf_docs, public):
    want = reference(public, True)
    got = tc.count_tokens(sf_docs.repartition(2), PATH).collect()
    texts = {r.doc_id: r.text for r in sf_docs.collect()}
    assert len(got) == len(texts)
    assert all(r.n_tokens == want(texts[r.doc_id]) and r.n_chars == len(texts[r.doc_id]) for r in got)


def test_random_texts(public):
    rnd, want, counter = random.Random(9), reference(public, True), tc.Counter(public, cache_words=100)
    bits = [" ", "  ", "\n", "\n\n", "\t", "a", "the", "ing", "▁", "é", "日", "😀", "0", "12", ".", ",", "\r", "xq", "ß", "of", "–"]
    for _ in range(4000):
        s = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25)))
        assert counter.count(s) == want(s), repr(s)


def test_ties_and_unknowns_of_small_vocabularies():
    """Whole scores tie often; pieces may reach over spaces; fractions forbid word by word counting."""
    rnd = random.Random(10)
    for trial in range(60):
        letters = "abc▁"
        pieces = {c: float(-rnd.randint(1, 4)) for c in letters if rnd.random() < 0.8}
        for _ in range(12):
            p = "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 4)))
            pieces[p] = float(-rnd.randint(1, 6)) if trial % 2 else -rnd.random() * 6
        v = tc.Vocabulary(pieces, min(pieces.values()) - tc.UNKNOWN_PENALTY, False)
        want, counter = reference(v, False), tc.Counter(v)
        for _ in range(60):
            s = "".join(rnd.choice("abcd \n") for _ in range(rnd.randint(0, 14)))
            assert counter.count(s) == want(s), (pieces, s)


def test_odd_rows(spark, odd_docs, public):
    want = reference(public, True)
    got = sorted((r.doc_id or 0, r.n_tokens) for r in tc.count_tokens(odd_docs, PATH).collect())
    assert got == sorted((r.doc_id or 0, want(r.text or "")) for r in odd_docs.collect())
    assert tc.count_tokens(odd_docs.where("false"), PATH).count() == 0
