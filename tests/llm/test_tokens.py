import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayflow.llm import bpe, token_counts, token_files
from stayflow.llm.eliasfano import EliasFano
from stayflow.llm.store import new_folder
from tests.llm import cases

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
PIECES = ["a", "b", " ", "  ", "\n", "1", "é", "中", "'s", "'ll", "!!", "\x1c", "\x85", "aaaa", "the ", "ing", "😀", "\r\n"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.parse_ranks(bpe.read_ranks(MULTI))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def mixtures(n, seed, longest=14):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, longest))) for _ in range(n)]


def test_transducer_equals_the_library(ranks, library):
    encoder = bpe.Encoder(ranks, PATTERN)
    texts = [*mixtures(3000, 1), *[t for _, t, *_ in cases.documents() if t], "ab" * 5000, "a" * 3000, "ing" * 999]
    for text in texts:
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_small_vocabularies_equal_plain_merging():
    r = random.Random(2)
    for _ in range(30):
        tokens = [bytes([b]) for b in b"abc"]
        while len(tokens) < r.randint(4, 25):
            new = r.choice(tokens) + r.choice(tokens)
            if new not in tokens:
                tokens.append(new)
        ranks = {t: i for i, t in enumerate(tokens)}
        machine = bpe.Transducer(ranks)
        if any(machine.parts(i) is None for i in range(len(tokens))):
            continue  # not what merging in this order makes
        for _ in range(60):
            piece = bytes(r.choice(b"abc") for _ in range(r.randint(1, 90)))
            want = [ranks[p] for p in machine.merged(piece, len(tokens))] if piece not in ranks else [ranks[piece]]
            assert machine.encode_piece(piece) == want


def test_states_are_dropped_and_made_again(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    monkeypatch.setattr(bpe, "MAX_CHUNKS", 20)
    encoder = bpe.Encoder(ranks, PATTERN)
    for text in mixtures(500, 3):
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_decoder_waits_for_the_rest_of_a_character(ranks):
    decoder = bpe.Decoder(ranks)
    ids = [ranks[bytes([b])] for b in "a漢😀".encode()]
    assert [decoder.feed([i]) for i in ids] == ["a", "", "", "漢", "", "", "", "😀"]
    assert decoder.feed(ids[1:3]) == "" and decoder.end() == "�" and decoder.feed(ids[:1]) == "a"


def test_round_trip_of_awkward_rows(spark, library):
    docs = cases.frame(spark)
    got = cases.plain(bpe.round_trip(docs, MULTI, PATTERN).collect())
    want = []
    for doc_id, text, *_ in cases.documents():
        ids = library.encode_ordinary(text or "")
        joined = ",".join(map(str, ids)).encode()
        want.append((doc_id, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == cases.plain(want)
    assert bpe.round_trip(docs.limit(0), MULTI, PATTERN).count() == 0


def test_columns_decode_to_the_text(spark):
    tokens = bpe.ByteBPE(spark, MULTI, PATTERN)
    docs = cases.frame(spark)
    ids = bpe.encode_documents(docs, MULTI, PATTERN)
    back = ids.select("doc_id", tokens.decode(F.col("ids")).alias("text")).collect()
    assert cases.plain(back) == cases.plain([(i, t or "") for i, t, *_ in cases.documents()])
    rows = bpe.token_rows(docs, MULTI, PATTERN).collect()
    assert len(rows) == docs.count() and all(r["restored"] and len(r["ids"]) == r["n_tokens"] for r in rows)


@pytest.mark.parametrize("n", [0, 1, 2, 300, 3000])
@pytest.mark.parametrize("last", [0, 5, 1000, 10**6])
def test_elias_fano_selects_what_it_holds(n, last):
    values = np.sort(np.random.default_rng(n + last).integers(0, last + 1, n))
    coded = EliasFano.of(values)
    assert (coded.all() == values).all()
    assert all(coded.select(i) == values[i] for i in range(0, n, max(1, n // 50)))
    with pytest.raises(IndexError):
        coded.select(n)
    if n:
        assert 8 * (len(coded.low) + len(coded.high)) <= n * (3 + max(0, np.log2(max(1, values[-1]) / n)) + 1) + 16


@pytest.mark.parametrize("block", [5, 1_000_000])
def test_token_files_give_back_every_document(spark, monkeypatch, block):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    monkeypatch.setattr(token_files, "BLOCK_IDS", block)
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(cases.frame(spark), folder, path)
    got = token_files.read_document_digests(spark, folder).collect()
    order = sorted(cases.documents(), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for doc_id, text, *_ in order:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert cases.plain(got) == cases.plain(want)
    row = next(token_files.read_tokens(spark, folder).toLocalIterator())
    ends = token_files.block_ends(row)
    assert [ends.select(i) for i in range(ends.n)] == ends.all().tolist()


def test_token_files_of_an_empty_table(spark):
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(cases.frame(spark, []), folder, public_tokenizers.path("byte_bpe_50k.json"))
    assert token_files.read_document_digests(spark, folder).count() == 0


def test_special_strings_are_ordinary_text_or_not():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        content = file.read()
    text = "a <|endoftext|> b<|endoftext|>"
    for as_text in (True, False):
        encoder = token_files.LibraryEncoder(content, 2, as_text)
        ids = np.frombuffer(encoder.encode(text), "<u2").tolist()
        plain = Tokenizer.from_str(content)
        plain.encode_special_tokens = as_text
        assert ids == plain.encode(text, add_special_tokens=False).ids
        assert (50256 in ids) == (not as_text)


@pytest.fixture(scope="module")
def count():
    return token_counts.counter_of(bpe.read_ranks(MULTI), PATTERN)


def test_trees_follow_random_edits(count, monkeypatch):
    monkeypatch.setattr(token_counts, "LEAF", 8)
    r = random.Random(3)
    for text in mixtures(300, 4, 60):
        tree = token_counts.TokenTree.of(text, count)
        for _ in range(6):
            start, removed = r.randint(-1, len(text) + 2), r.randint(0, 12)
            inserted = "".join(r.choice(PIECES) for _ in range(r.randint(0, 6)))
            tree.edit(start, removed, inserted)
            start = min(max(start, 0), len(text))
            text = text[:start] + inserted + text[start + removed :]
            assert (tree.text, tree.n_chars, tree.n_tokens) == (text, len(text), count(text))


def test_an_edit_of_a_long_text_encodes_little(count):
    tree = token_counts.TokenTree.of(cases.text(40_000, 2), count)
    tree.edit(90_000, 5, "other")
    assert tree.encoded < 4 * token_counts.LEAF


def test_recounts_of_awkward_rows(spark, count):
    edits = spark.createDataFrame(
        [(1, 2, 3, 4, "late"), (1, 1, 0, 1, "First "), (4, 1, 5, 5, "new"), (5, 1, 0, 0, None), (9, 1, 70_000, None, "x"),
         (11, 1, 10**6, 3, " end"), (99, 1, 0, 0, "nobody"), (None, 1, 0, 0, "none"), (12, 1, None, 2, "")],
        "doc_id long, seq int, start long, removed long, inserted string",
    )
    got = token_counts.recount(cases.frame(spark), edits, MULTI, PATTERN).collect()
    by_id = {}
    for doc_id, seq, start, removed, inserted in sorted(
        [tuple(r) for r in edits.collect() if r["doc_id"] is not None], key=lambda r: r[:2]
    ):
        by_id.setdefault(doc_id, []).append((start or 0, removed or 0, inserted or ""))
    want = []
    for doc_id, text, *_ in cases.documents():
        text = edited = text or ""
        for start, removed, inserted in by_id.get(doc_id, []):
            start = min(start, len(edited))
            edited = edited[:start] + inserted + edited[start + removed :]
        want.append((doc_id, len(text), count(text), len(by_id.get(doc_id, [])), len(edited), count(edited), edited))
    names = ["doc_id", "n_chars", "n_tokens", "edits", "edited_chars", "edited_tokens", "edited_text"]
    assert cases.plain([[r[n] for n in names] for r in got]) == cases.plain(want)
    assert all(sum(r["leaf_tokens"]) == r["edited_tokens"] and sum(r["leaf_chars"]) == r["edited_chars"] for r in got)
    assert token_counts.recount(cases.frame(spark, []), edits, MULTI, PATTERN).count() == 0


def test_rank_files_hold_every_byte(ranks):
    assert all(bytes([b]) in ranks for b in range(256))
    assert base64.b64decode(base64.b64encode(b"x")) == b"x"
