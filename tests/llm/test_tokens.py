import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from driftlog.llm import pieces, tokenids
from driftlog.llm.common import shared_path


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary()


def odd_texts(parts, n, seed):
    random.seed(seed)
    return ["".join(random.choice(parts) for _ in range(random.randint(0, 24))) for _ in range(n)]


def test_piece_ids_equal_the_library(vocabulary, documents):
    texts = odd_texts(["a", "th", "in", "er", "  ", " ", "\n", "é", "漢", "字", "🙂", "'s", "...", "12", "AAAA", "▁", "\x00", "<s>", "<0x41>"], 3000, 1)
    texts += ["x" * 3000, "ab" * 2000, " " * 99] + [r["text"] for r in documents.collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    ids = pieces.encode_batch(pa.array(texts), pieces.Encoder(vocabulary))
    assert ids.to_pylist() == library.encode(texts)
    assert pieces.decode_batch(ids, vocabulary).to_pylist() == library.decode(library.encode(texts))


def test_unigram_search_takes_the_best_sum(vocabulary):
    v = pieces.Vocabulary()
    v.bpe = False
    word = "theoretically"
    codes = v.char[np.array([[ord(c) for c in word]])]
    _, ids = pieces.Encoder(v).viterbi(codes)
    text = {int(i): v.raw[b : b + n].tobytes().decode() for i, b, n in zip(v.ids, v.raw_begin[v.ids], v.raw_size[v.ids], strict=True)}
    by_text = {t: v.score[i] for i, t in text.items() if not t.startswith(" ")}
    best = [0.0] + [-np.inf] * len(word)
    for i in range(1, len(word) + 1):
        best[i] = max(best[j] + by_text.get(word[j:i], -np.inf) for j in range(i))
    assert "".join(text[int(i)] for i in ids) == word and abs(sum(v.score[ids]) - best[-1]) < 1e-6


def test_pieces_on_awkward_and_empty(awkward, nothing):
    rows = {r["doc_id"]: r for r in pieces.encode_checked(awkward).select("doc_id", "n_pieces", "ids", "ids_crc32", "lossless").collect()}
    assert rows[3]["n_pieces"] == rows[4]["n_pieces"] == 0 and rows[3]["lossless"] and rows[6]["lossless"]
    assert not rows[8]["lossless"]  # a written U+2581 decodes as a space, as in the library
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows.values())
    assert pieces.encode_checked(nothing).count() == 0
    back = pieces.decode(pieces.encode(awkward.select("doc_id", "text"))).where("doc_id = 6").collect()[0]
    assert back["decoded"] == back["text"]


def test_token_ids_equal_the_library():
    texts = odd_texts(["a", "B", "é", "É", "'s", "'", "'re", "<", "<|endoftext|>", "|", ">", "5", "12", "...", "́", "̱", "H", "Σ", "…", "漢", "🙂", " ", " ", "\n", "\x00", "İ", "ß", "don't", "K", "̸", "=", "\x85"], 5000, 2)
    encoder = tokenids.WordEncoder(tokenids.VOCAB)
    got = [x.tolist() for x in tokenids.encoded(pa.array([*texts, None]), encoder, 2)]
    assert got == [e.ids + [2] for e in encoder.tokenizer.encode_batch([*texts, ""], add_special_tokens=False)]


def test_cache_limit_changes_no_ids(monkeypatch):
    texts = pa.array(odd_texts(["ab", "cd ", "ef", " g", "12"], 400, 3))
    whole = [x.tolist() for x in tokenids.encoded(texts, tokenids.WordEncoder(tokenids.VOCAB), 2)]
    monkeypatch.setattr(tokenids.tk, "CHUNK_BYTES", 64)
    small = tokenids.WordEncoder(tokenids.VOCAB)
    small.cache.limit = 5
    assert [x.tolist() for c in range(0, 400, 7) for x in tokenids.encoded(texts[c : c + 7], small, 2)] == whole


def test_files_come_back_in_order(spark, awkward):
    library = Tokenizer.from_file(public_tokenizers.path(tokenids.VOCAB))
    path = tokenids.write_ids(awkward, shared_path(spark, "test-ids"), shard_bytes=300)
    rows = sorted(tokenids.read_ids(spark, path).collect(), key=lambda r: r["start"])
    given = awkward.select("doc_id", "text").collect()
    assert len(rows) == len(given) and rows[0]["doc_id"] is None
    assert [r["doc_id"] for r in rows[1:]] == sorted(r["doc_id"] for r in given if r["doc_id"] is not None)
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    want = {(r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids + [2])) for r in given}
    assert {(r["doc_id"], tuple(r["ids"])) for r in rows} == want
    assert tokenids.read_document(spark, path, 9).collect()[0]["ids"] == library.encode("You are an idiot. Fine day.", add_special_tokens=False).ids + [2]


def test_no_documents_make_no_shards(spark, nothing):
    path = tokenids.write_ids(nothing, shared_path(spark, "test-ids"))
    assert tokenids.read_ids(spark, path, digest=True).count() == 0


def test_tasks_of_a_worker_share_an_encoder():
    from driftlog.llm import tokenids

    one = tokenids.worker_encoder(tokenids.VOCAB)
    assert tokenids.worker_encoder(tokenids.VOCAB) is one
