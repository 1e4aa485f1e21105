"""BPE and Huffman files against the tokenizers library."""

import hashlib
import json
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from roomtide.llm import bpe, huffman
from roomtide.llm.queries import vocabulary

from llm_data import ODD, docs, prose  # noqa: F401

TRICKY = [
    "", " ", "a  b\n\n c", "a\x1cb c", "\x1f\x1e", "İstanbul ΣΑΣ ς", "<|endoftext|>x <|startoftext|>y<|endoftext|", "é Å ́a",
    "it's 'something 'll'd 'RE", "½²³③٣ 12345", "日本語テキスト", "\U0001F600👍🏽", "ﬁ ẞ ǅ", "\xa0x\x85y　z", "\x00\x01", "don't <|endoftext|> stop",
    "tab\t\ttab\r\nline", "a" * 3000, "x y", "ªº ¼",
]


@pytest.fixture(scope="module")
def library():
    return {n: Tokenizer.from_file(vocabulary(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


def random_texts(n=400):
    rng = random.Random(7)
    pools = [(32, 127), (0x80, 0x250), (0x250, 0x600), (0x1E00, 0x2100), (0x300, 0x370), (0, 33), (0xAC00, 0xD7A3)]
    return ["".join(chr(rng.randrange(*rng.choice(pools))) for _ in range(25)) for _ in range(n)]


def random_spaces(n=400):
    rng = random.Random(8)
    return ["".join(rng.choice(" \n\t ab'1.é\xa0  ") for _ in range(rng.randrange(1, 20))) for _ in range(n)]


def test_codec_equals_the_library(library):
    coder, known = bpe.BpeCodec(vocabulary("word_bpe_49k.json")), library["word_bpe_49k.json"]
    for text in TRICKY + random_texts() + [prose(random.Random(1), 300)]:
        ids = known.encode(text, add_special_tokens=False).ids
        assert coder.encode(text).tolist() == ids
        assert coder.decode(ids) == known.decode(ids, skip_special_tokens=False)


def test_merges_equal_a_plain_scan():
    coder, rng = bpe.BpeCodec(vocabulary("word_bpe_49k.json")), random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("aeinrst") for _ in range(rng.randrange(1, 25)))
        symbols = [coder.inner[b] for b in word.encode()]
        symbols[-1] = coder.last[ord(word[-1])]
        plain = list(symbols)
        while True:
            ranked = [(coder.ranks[k], i) for i, k in enumerate(a << 20 | b for a, b in zip(plain, plain[1:])) if k in coder.ranks]
            if not ranked:
                break
            rank, i = min(ranked)
            plain[i : i + 2] = [coder.merged[rank]]
        assert coder.merge(symbols) == plain


def test_round_trip_digests(docs, library):
    rows = ODD + [(9, t) for t in TRICKY]
    known = library["word_bpe_49k.json"]
    got = bpe.round_trip_digests(docs(rows), vocabulary("word_bpe_49k.json")).collect()
    expected = []
    for doc_id, text in rows:
        ids = known.encode(text or "", add_special_tokens=False).ids
        expected.append((
            doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(known.decode(ids, skip_special_tokens=False).encode()).hexdigest(),
        ))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert bpe.round_trip_digests(docs([]), vocabulary("word_bpe_49k.json")).count() == 0


def test_ids_and_texts_as_columns(docs):
    path = vocabulary("word_bpe_49k.json")
    encoded = bpe.encode_documents(docs([(1, "Hello World"), (2, None)]), path)
    assert encoded.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids"]
    decoded = {r.doc_id: r.decoded for r in bpe.decode_documents(encoded, path).collect()}
    assert decoded == {1: "hello</w> world</w>", 2: ""}


def test_word_encoder_equals_the_library(library):
    encoder, known = huffman.WordEncoder(vocabulary("byte_bpe_50k.json")), library["byte_bpe_50k.json"]
    spaced = ["a  b", "a   b c", " a b ", "a \n b", "a\n b", "x \t y  ", "end.\nNext one. \nLast", "\xa0 a\x85 b", "a ' b 's c 1 ! é"]
    for text in TRICKY + spaced + random_texts() + random_spaces() + [prose(random.Random(9), n) for n in (1, 2, 500)]:
        assert np.frombuffer(encoder(text), encoder.kind).tolist() == known.encode(text, add_special_tokens=False).ids


def test_new_short_words_are_merged_together_and_not_one_by_one(library):
    encoder, known = huffman.WordEncoder(vocabulary("byte_bpe_50k.json")), library["byte_bpe_50k.json"]
    asked, model = [], encoder.model

    class Model:
        def tokenize(self, word):
            asked.append(word)
            return model.tokenize(word)

    encoder.model = Model()
    rng = random.Random(11)
    words = ["".join(rng.choice("aeinrstèß") for _ in range(rng.randrange(1, 16))) for _ in range(5000)]
    text = " ".join(w + rng.choice(["", "", ",", ".\n", "12", "'s"]) for w in words) + "x " + "long" * 20
    assert np.frombuffer(encoder(text), encoder.kind).tolist() == known.encode(text, add_special_tokens=False).ids
    assert asked == ["\u0120" + "long" * 20]


@pytest.mark.parametrize("places, remembered, batch", [(huffman.PLACES, huffman.REMEMBERED_PIECES, huffman.BATCH_PIECES), (1 << 9, 400, 90)])
def test_texts_encoded_together_equal_the_library(library, monkeypatch, places, remembered, batch):
    monkeypatch.setattr(huffman, "PLACES", places)
    monkeypatch.setattr(huffman, "REMEMBERED_PIECES", remembered)
    monkeypatch.setattr(huffman, "BATCH_PIECES", batch)
    encoder, known = huffman.WordEncoder(vocabulary("byte_bpe_50k.json")), library["byte_bpe_50k.json"]
    rng = random.Random(10)
    texts = TRICKY + random_texts() + random_spaces(2000) + ["a\0", "a", "a\0\0"] + [prose(rng, rng.randrange(1, 300)) for _ in range(40)]
    texts += ["".join(rng.choice("ab'1.é×÷\xb5\xaa\u0241\n\t ") for _ in range(rng.randrange(1, 40))) for _ in range(2000)]
    expected = [np.array(e.ids, encoder.kind).tobytes() for e in known.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == expected
    rng.shuffle(texts)
    assert encoder.encode(texts) == [np.array(known.encode(t, add_special_tokens=False).ids, encoder.kind).tobytes() for t in texts]
    assert encoder.encode([]) == [] and encoder.encode(["", ""]) == [b"", b""]


def test_a_vocabulary_that_ignores_merges(tmp_path):
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"]["ignore_merges"] = True
    spec["model"]["merges"] = spec["model"]["merges"][:1000]
    spec["model"]["vocab"] = {**spec["model"]["vocab"], "\u0120zzq": 50257}
    path = tmp_path / "vocabulary.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    encoder, known = huffman.WordEncoder(str(path)), Tokenizer.from_file(str(path))
    for text in ["a zzq, and zzq", "", *TRICKY]:
        assert np.frombuffer(encoder(text), encoder.kind).tolist() == known.encode(text, add_special_tokens=False).ids


def test_an_encoder_that_failed_begins_anew(monkeypatch):
    encoder = huffman.WordEncoder(vocabulary("byte_bpe_50k.json"))
    expected = encoder("some words, and more")
    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr(encoder, "_pieces", lambda *_: (_ for _ in ()).throw(RuntimeError()))
        encoder("other words, and even more")
    assert encoder("some words, and more") == expected
    assert encoder("other words, and even more") == huffman.WordEncoder(vocabulary("byte_bpe_50k.json"))("other words, and even more")


@pytest.mark.parametrize("size", [1, 2, 3, 60, 3000])
def test_huffman_codes(size):
    rng = random.Random(size)
    counts = np.array([max(1, int(rng.random() ** -4)) for _ in range(size)])
    counts[rng.randrange(size)] += 3
    lengths = huffman.code_lengths(counts)
    used = lengths[lengths > 0].astype(float)
    assert lengths.max() <= huffman.LONGEST_CODE and (size == 1 or (2.0**-used).sum() == 1.0)
    ids = rng.choices(range(size), k=5000)
    bits, checkpoints = huffman.pack_ids(np.array(ids), huffman.canonical_codes(lengths), lengths)
    assert len(checkpoints) == -(-len(ids) // huffman.BLOCK_IDS)
    assert huffman.unpack_ids(bits, checkpoints, len(ids), huffman.decode_table(lengths)).tolist() == ids


def test_lengths_are_optimal_where_the_limit_does_not_bind():
    import heapq

    counts = np.array([random.Random(3).randrange(1, 500) for _ in range(200)])
    heap, cost = sorted(counts.tolist()), 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    assert (huffman.code_lengths(counts).astype(int) * counts).sum() == cost
    steep = np.array([2**k for k in range(40)], np.int64)  # the limit binds
    limited = huffman.code_lengths(steep)
    assert limited.max() == huffman.LONGEST_CODE and (2.0 ** -limited.astype(float)).sum() <= 1


@pytest.mark.parametrize("segment_ids", [huffman.SEGMENT_IDS, 500])
def test_files_give_back_every_id(docs, library, monkeypatch, segment_ids):
    monkeypatch.setattr(huffman, "SEGMENT_IDS", segment_ids)
    rng = random.Random(4)
    rows = ODD + [(10 + k, prose(rng, rng.randrange(1, 400))) for k in range(40)] + [(50, TRICKY[6])]
    got = huffman.round_trip(docs(rows), vocabulary("byte_bpe_50k.json")).orderBy("start").collect()
    known, start = library["byte_bpe_50k.json"], 0
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(text)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    for row in got:
        options = {}
        for text in texts[row.doc_id]:
            ids = known.encode(text or "", add_special_tokens=False).ids + [0]
            options[len(ids)] = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert row.start == start and options[row.n_tokens] == row.ids_crc32
        start += row.n_tokens
    assert huffman.round_trip(docs([]), vocabulary("byte_bpe_50k.json")).count() == 0
