"""Token alignment against plain loops over both token lists."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF_SMALL
from tests.llm import brute
from trendstats.llm import alignment
from trendstats.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, pair long, container string, at int"
AWKWARD = [
    None, "", " ", "  two  spaces ", "a▁b", "<|endoftext|> <s>x</s><unk>", "tabs\t\tand\r\nlines\n\n\nend ", "\x00nul", "é ﬁ ① 😀👩‍👩‍👧",
    "don't we'll 'S 12345 1.5e-3", "x" * 5_000, " " * 5_000 + "y", "日本語のテキスト", "the the the the", "the the the the", " nbsp　wide",
]


@pytest.fixture(scope="module")
def files():
    return alignment.read_file(alignment.A_FILE), alignment.read_file(alignment.B_FILE)


def prose(seed, n=40):
    r = random.Random(seed)
    words = ["".join(r.choice("aeiourstlné") for _ in range(r.randrange(1, 9))) for _ in range(300)]
    return [" ".join(r.choice(words) + r.choice(["", "", ",", ".\n", "!"]) for _ in range(r.randrange(200))) for _ in range(n)]


def found(spark, texts, files, parts=3, **options):
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in enumerate(texts)], SCHEMA).repartition(parts)
    docs, pairs = alignment.align(docs, *files, **options)
    rows = [tuple(r)[1:] for r in sorted(docs.collect(), key=lambda r: r[0])]
    return rows, {(p["a"], p["b"]): (p["n_links"], p["n_docs"], p["best"]) for p in pairs.collect()}


def test_awkward_texts(spark, files):
    assert found(spark, AWKWARD, files) == brute.alignment(AWKWARD, *files)


def test_small_pieces_segments_and_containers_change_nothing(spark, files):
    texts = AWKWARD + prose(1) + ["the " * 3_000 + "end"] * 3
    want = brute.alignment(texts, *files)
    assert found(spark, texts, files) == want
    assert found(spark, texts, files, parts=2, piece=50, segment=300, limits=(16, 2_000)) == want


def test_digest_is_the_hash_of_the_groups(spark, files):
    texts = AWKWARD + prose(2, 5)
    full, digest = found(spark, texts, files)[0], found(spark, texts, files, digest=True)[0]
    assert [(*r[:-1], brute.sha(r[-1]) if r[-1] else "") for r in full] == digest


def test_a_common_pair_in_many_documents(spark, files):
    texts = ["the end of the day"] * 700 + ["an end"] * 5
    assert found(spark, texts, files, segment=500, limits=(64, 10_000)) == brute.alignment(texts, *files)


def test_bitmaps_come_back():
    r = np.random.default_rng(1)
    pair, doc = np.divmod(np.unique(r.integers(0, 50 * 3_000, 20_000)), 3_000)
    doc = np.concatenate((doc, np.arange(3_000)))
    pair = np.concatenate((pair, np.full(3_000, 77)))
    many = r.integers(1, 6, len(doc))
    want = sorted(zip(pair.tolist(), doc.tolist(), many.tolist()))
    got = {}
    kinds = set()
    for cols in alignment.encode(5, *alignment.planes_of(pair, doc, many)):
        dense = cols["dense"]
        kinds.add(bool(dense[0]))
        row, at = alignment.decode(dense, cols["bits"])
        assert (np.bincount(row, minlength=len(dense)) == cols["n"]).all()
        for k, d in zip(row.tolist(), at.tolist()):
            key = (int(cols["pair"][k]), d)
            got[key] = got.get(key, 0) + (1 << int(cols["plane"][k]))
    assert kinds == {True, False}
    assert sorted((*k, v) for k, v in got.items()) == want
    assert alignment.decode(np.empty(0, dtype=bool), pa.array([], pa.binary()))[0].size == 0


def test_both_encoders_of_a_agree_and_long_runs_end(files):
    bpe = alignment.ByteBpe(files[0])
    assert bpe.fast is not None
    for text in [t for t in AWKWARD if t] + prose(3, 10):
        assert bpe.fast.encode_ordinary(" " + text) == bpe.slow().encode(" " + text, add_special_tokens=False).ids
    for text in (" " * 1_000_000, "a" * 1_000_000, "\n" * 300_000):
        assert b"".join(bpe.bytes[i] for i in bpe.encode([text])[0]) == (" " + text).encode()


def test_pieces_join_to_the_text():
    for text in ["", "abc", "a b c d " * 40, "  a   b  " * 30, "x" * 500, "x" * 300 + " y" * 100]:
        for limit in (5, 17, 100):
            assert " ".join(alignment.pieces_of(text, limit)) == text


def test_possible_pairs_bounds_what_occurs(spark, files):
    a, b = alignment.ByteBpe(files[0]).bytes, alignment.PieceBpe(files[1]).bytes
    assert alignment.possible_pairs([b"ab", b"b", b""], [b"b", b"ab", b"cab"]) == 6
    pairs = found(spark, prose(4), files)[1]
    assert 0 < len(pairs) < alignment.possible_pairs(a, b)
    assert all(a[x].endswith(b[y]) or b[y].endswith(a[x]) for x, y in pairs)


def test_the_query(spark, files, edge_dir):
    for folder in (SF_SMALL, edge_dir):
        docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
        rows, _ = brute.alignment([d["text"] for d in docs], *files)
        want = sorted(repr((d["doc_id"], *r[:-1], brute.sha(r[-1]) if r[-1] else "")) for d, r in zip(docs, rows))
        assert sorted(repr(tuple(r)) for r in QUERIES["op11_token_alignment"](spark, folder).collect()) == want
