"""BPE transducers against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridwise.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "b", "th", "the", "in", "an", "er", " ", "  ", "\n", "\t", "\x0b", "'s", "'ll", "é",
          "é", "Σ", "ς", "İ", "ß", "1", "²", "½", "!", "...", "<|endoftext|>",
          "<|startoftext|>", "<|", "​", "\xa0", "\x1f", "\x85", "日本", "ﬁ", "😀", "Ａ", "\x00",
          " ", "ǅ", "한"]


@pytest.fixture(scope="module")
def vocab():
    return bpe.Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(encoder, text):
    return np.frombuffer(b"".join(bpe.stream_ids(encoder, text)), "<u4").tolist()


def test_streams_equal_the_library(vocab, library):
    draw = random.Random(7)
    for _ in range(400):
        text = "".join(draw.choice(PIECES) for _ in range(draw.randrange(60)))
        want = library.encode(text, add_special_tokens=False).ids
        for block, window in ((1 << 16, 4096), (8, 4), (17, 40)):
            assert ids_of(bpe.Encoder(vocab, block, window), text) == want, (block, text)
        decoder = bpe.Decoder(vocab)
        parts = b"".join(decoder.feed(want[i:i + 3]) for i in range(0, len(want), 3))
        assert (parts + decoder.finish()).decode() == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 20000, "the" * 5000, "é" * 9000, "!?" * 7000, "x1" * 3000])
def test_long_words_in_small_windows(vocab, library, text):
    encoder = bpe.Encoder(vocab, 1000, 300)
    assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_random_long_word_needs_no_more_than_the_lookahead(vocab, library):
    draw = random.Random(3)
    word = "".join(draw.choice("abcdethinrsaao") for _ in range(20000))
    assert 0 < vocab.lookahead < 10000
    assert ids_of(bpe.Encoder(vocab, 500, 8), word) == library.encode(
        word, add_special_tokens=False).ids


def test_merges_over_arrays_equal_merges_one_by_one(vocab):
    draw = random.Random(5)
    words = [bytes(draw.randrange(256) if draw.random() < 0.2 else draw.choice(b"etaoinshr")
                   for _ in range(draw.randrange(1, 32))) for _ in range(500)]
    one = [bpe._packed(vocab.merged([*(vocab.inner[b] for b in w[:-1]), vocab.last[w[-1]]]))
           for w in words]
    assert vocab.merged_words(words) == one


def test_lookahead_bound_on_a_small_merge_list():
    # merges: bc, then a+bc; whether "a" merges is known two symbols further
    merges, lengths = [(1, 2, 3), (0, 3, 4)], [1, 1, 1, 2, 3]
    assert bpe.sufficient_lookahead(merges, lengths) == 2
    assert bpe.sufficient_lookahead([], [1, 1]) == 0


def test_byte_level_decoder_holds_back_open_characters(vocab):
    decoder = bpe.Decoder(vocab)
    decoder.state = __import__("codecs").getincrementaldecoder("utf-8")("replace")
    decoder.pieces = ["é".encode()[:1], "é".encode()[1:], b"x"]
    assert decoder.feed([0]) == b"" and decoder.feed([1, 2]) == "éx".encode()
    assert decoder.feed([0]) == b"" and decoder.finish() == "�".encode()


def test_dataframe_forms(spark, library):
    rows = [(1, "Hello  World's", "x"), (2, None, None), (3, "", "y"), (1, "Hello  World's", "x"),
            (4, "word " * 60000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in bpe.digests(docs, PATH).collect()}
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    encoded = bpe.encode(docs, PATH)
    lists = {r.doc_id: r for r in bpe.tokenized(docs, PATH, batch_chars=10).collect()}
    assert {k: (r.ids_sha256, r.decoded_sha256) for k, r in lists.items()} == {
        k: (r.ids_sha256, r.decoded_sha256) for k, r in got.items()}
    assert {r.doc_id: r.ids for r in encoded.collect()} == {k: r.ids for k, r in lists.items()}
    assert bpe.tokenized(docs.limit(0), PATH).count() == 0
    back = {r.doc_id: r.decoded for r in bpe.decode(encoded, PATH).collect()}
    assert back[1] == library.decode(library.encode("Hello  World's").ids, skip_special_tokens=False)
    assert back[2] == back[3] == ""
    assert bpe.digests(docs.limit(0), PATH).count() == 0


def test_a_full_cache_is_not_cleared_while_in_use(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 30)
    encoder = bpe.Encoder(bpe.vocabulary(bpe.default_vocabulary()))
    calls, long_chunk = [], encoder._long_chunk
    monkeypatch.setattr(encoder, "_long_chunk", lambda chunk: calls.append(chunk) or long_chunk(chunk))
    texts = [f"Word{i} other{i}. Again" for i in range(20)]
    for text in bpe.learn_batch(encoder, texts):
        b"".join(bpe.stream_ids(encoder, text))
    assert not calls  # before, learned chunks were lost and made again one by one


def test_words_merged_together_equal_words_merged_alone():
    v = bpe.vocabulary(bpe.default_vocabulary())
    draw = random.Random(5)
    words = [bytes(draw.choice(b"aeinorst") for _ in range(n)) for n in range(1, 33) for _ in range(30)]
    words += [draw.randbytes(n) for n in range(1, 33)] + [b"aaaaaaaa", b"ababababab", b"the", b"t"]
    got = v.merged_words(words)
    for word, ids in zip(words, got):
        alone = v.merged([*(v.inner[b] for b in word[:-1]), v.last[word[-1]]])
        assert np.frombuffer(ids, "<u4").tolist() == alone
