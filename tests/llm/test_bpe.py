import random

import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from eventlens.llm import bpe

FILE = path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tables():
    return bpe.Tables(FILE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


TEXTS = [
    "", " \n\t", "Don't we'll I'D", "<|endoftext|>a<|startoftext|>", "ΑΣ Σ İ ẞ ﬁ é", "日本語 1234 ½", "Ᲊ \U000323b0",
    "a\x00b\x85c d", "🙂👍🏽", "thing" * 700, "x" * 3000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids_and_text_as_the_library(tables, library, text):
    ids = bpe.Encoder(tables).encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    decoder = bpe.Decoder(tables)
    assert "".join(map(decoder.push, ids)) == library.decode(ids, skip_special_tokens=False)


def test_long_words_pass_a_small_buffer(tables, library):
    rng = random.Random(5)
    for letters in ("ab", "aeinrst", "the"):
        word = "".join(rng.choice(letters) for _ in range(4000))
        encoder = bpe.Encoder(tables)
        assert encoder.encode(word) == library.encode(word, add_special_tokens=False).ids
    transducer, held = encoder.transducer, 0
    for _ in range(100):
        transducer.push("the" * 85)
        held = max(held, len(transducer.pending))
    assert held <= tables.lookahead + 2 * bpe.CHUNK


def test_lookahead_of_small_lists():
    assert bpe.sufficient_lookahead([]) == 0
    assert bpe.sufficient_lookahead([("a", "b")]) == 1
    # b takes part in bc or not, then a in ab: two letters back
    assert bpe.sufficient_lookahead([("b", "c"), ("a", "b")]) == 2
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([("ab", "c"), ("a", "b")])


def test_emitted_tokens_never_change():
    merges = [("b", "a"), ("a", "a"), ("a", "b"), ("aa", "b"), ("ba", "aab")]
    vocab = {t: i for i, t in enumerate(sorted({"a", "b", "a</w>", "b</w>"} | {x + y for x, y in merges}))}
    ranks = {p: i for i, p in enumerate(merges)}
    look, rng = bpe.sufficient_lookahead(merges), random.Random(1)
    for _ in range(300):
        word = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 60)))
        streamed = bpe.Transducer(vocab, ranks, look, chunk=1)
        ids = [i for c in word for i in streamed.push(c)] + streamed.end()
        whole = bpe.Transducer(vocab, ranks, look, chunk=1000)
        assert ids == whole.push(word) + whole.end()


def test_bytes_come_together(tables):
    encoder, decoder = bpe.Encoder(tables), bpe.Decoder(tables, as_bytes=True)
    ids = encoder.encode("Zoë's 日本 🙂")
    assert "".join(map(decoder.push, ids)) + decoder.end() == "zoë 's 日本 🙂"
