import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.orc
import sentencepiece
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from tablewright.llm import pieces
from tablewright.llm.token_files import BYTE_BPE, read_token_files, token_index, write_token_files
from tablewright.llm.words import tokenizer

ODD = ["a  b\n\n c x \x1f y it's 's <|endoftext|> z ²½ Ⅷ é́   q", " ", "", "日本 語…!! 😀x", "  lead", "trail  ", "<|endoftext|>", "'", "a'r", "\n'sx"]


def random_texts(n, letters=" \n\t 'strevlamd19²é́_!ßx日😀", seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_word_ids_equal_the_library():
    texts = ODD + random_texts(800)
    flat, lengths = tokenizer(BYTE_BPE).encode(pa.array(texts))
    library = Tokenizer.from_file(BYTE_BPE)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [p.tolist() for p in np.split(flat, np.cumsum(lengths)[:-1])] == want


def test_token_files(spark, odd_docs, no_docs, tmp_path):
    path = str(tmp_path / "ids")
    write_token_files(odd_docs, path, stripe_bytes=4096)
    library = Tokenizer.from_file(BYTE_BPE)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r))
    want, start = [], 0
    for doc_id, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_index(read_token_files(spark, path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    files = [f for f in os.listdir(path) if f.endswith(".orc")]
    assert sum(pa.orc.ORCFile(f"{path}/{f}").nrows for f in files) == len(rows)
    some = read_token_files(spark, path, [5, 12])
    assert sorted(r["doc_id"] for r in some.collect()) == [5, 5, 12]
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()
    empty = str(tmp_path / "none")
    write_token_files(no_docs, empty)
    assert token_index(read_token_files(spark, empty)).count() == 0


def unigram_library(model):
    proto = sentencepiece_model_pb2.ModelProto()
    with open(pieces.PIECE_MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for i, piece in enumerate(proto.pieces):
        if np.isfinite(model.scores[i]):
            piece.score = float(model.scores[i])
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_pieces_score_as_the_unigram_library(small_docs):
    model = pieces.load_pieces()
    library = unigram_library(model)
    texts = [t.replace("▁", "") for t in ODD + random_texts(500, " \n etanoish19²é́_!ß日😀", 4)]
    texts += [r["text"] for r in small_docs.limit(60).collect()]
    flat, lengths = pieces.PieceEncoder(model).encode(pa.array(texts))

    def score(ids):
        return sum(model.scores[i] if np.isfinite(model.scores[i]) else model.fallback for i in ids)

    for text, ids in zip(texts, np.split(flat, np.cumsum(lengths)[:-1])):
        want = library.encode(text)
        assert ids.tolist() == want or score(ids) >= score(want) - 1e-3, text


def test_viterbi_is_the_best_segmentation():
    model = pieces.load_pieces()
    by_text = {model.flat[a:a + n].tobytes(): i for i, (a, n) in enumerate(zip(model.starts.tolist(), model.lengths.tolist()))
               if np.isfinite(model.scores[i])}

    def brute(word):
        if not word:
            return 0.0
        best = -np.inf
        for k in range(1, len(word) + 1):
            head = word[:k].encode()
            if head in by_text:
                best = max(best, model.scores[by_text[head]] + brute(word[k:]))
            elif k == 1:
                best = max(best, model.fallback + brute(word[k:]))
        return best

    words = [w for w in random_texts(60, "ethanoisß日", 9) if 0 < len(w) <= 11]
    flat, counts = pieces.viterbi(model, [w.encode() for w in words])
    for word, ids in zip(words, np.split(flat, np.cumsum(counts)[:-1])):
        n_fallback = sum(1 for c in word if c.encode() not in by_text)
        found = sum(model.scores[i] for i in ids.tolist() if np.isfinite(model.scores[i]))
        if not n_fallback:
            assert abs(found - brute(word)) < 1e-9


def test_pieces_round_trip(odd_docs, no_docs, spark):
    encoded = pieces.encode_pieces(odd_docs)
    assert encoded.columns == [c for c in odd_docs.columns if c != "ids"] + ["ids"]
    rows = pieces.decode_pieces(encoded).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["decoded"] == (r["text"] or "") for r in rows)
    assert all(r["exact"] for r in pieces.round_trip(odd_docs).collect())
    marker = spark.createDataFrame([(1, "a▁b  ▁ c"), (2, "▁")], "doc_id long, text string")
    assert all(r["exact"] for r in pieces.round_trip(marker).collect())
    assert pieces.round_trip(no_docs).count() == 0
