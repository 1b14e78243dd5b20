"""The operators' own interfaces, and the ways they take at scale forced on
small inputs."""

from __future__ import annotations

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm import brute
from trendstats.llm import decontam, graph, lm, mixing, oracle, pii, secrets, simhash, spotsigs, tokens, toxicity, urls
from trendstats.llm.common import lowest, read_table, topmost
from trendstats.llm.queries import QUERIES


@pytest.mark.parametrize("rows, n", [(0, 5), (3, 5), (200, 5)])
def test_first_rows(spark, rows, n):
    """The first rows by hash and by order, in levels or at once, with
    repeated rows and ties."""
    data = [(i % 90, f"w{i % 90}") for i in range(rows)] * 2
    df = spark.createDataFrame(data, "n long, word string").repartition(40)
    hashed = df.select("n", "word", F.xxhash64("word").alias("h"))
    want = sorted({(r["h"], r["n"], r["word"]) for r in hashed.collect()})[:n]
    assert [(r["h"], r["n"], r["word"]) for r in lowest(hashed, n, F.col("h"), "n").collect()] == want
    once = df.distinct().withColumn("n", F.col("n") % 7).repartition(40)
    want = sorted((-r["n"], r["word"]) for r in once.collect())[:n]
    for tasks, fan in ((40, 8), (40, 16), (1, 16), (300, 20)):
        got = topmost(once, n, F.desc("n"), "word", tasks=tasks, fan=fan).collect()
        assert [(-r["n"], r["word"]) for r in got] == want, (tasks, fan)


def test_hot_key_of_the_lowest(spark):
    """Rows that repeat do not make the sample smaller."""
    df = spark.range(5000).select(F.when(F.col("id") < 4900, 7).otherwise(F.col("id")).alias("k"))
    assert lowest(df, 60, F.xxhash64("k")).count() == 60


def near(rng, base, bits):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bucket_rows", [8, 4096])
def test_simhash_links_are_complete(spark, bucket_rows):
    """One dense group in hot buckets (dealt out as chunk pairs), a chain, and
    noise: the classes are those of all pairs."""
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(150)]
    center = rng.getrandbits(64)
    fps += [near(rng, center, rng.randint(0, 5)) for _ in range(200)]
    step = rng.getrandbits(64)
    for _ in range(20):
        fps.append(step := near(rng, step, 3))
    fps = sorted(set(fps))
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = simhash.links(df, 3, bucket_rows)
    comps = {r["node"]: r["component"] for r in graph.connected_components(found).collect()}
    classes: dict = {}
    for f, c in zip(fps, brute.components(fps)):
        classes.setdefault(c, set()).add(signed(f))
    got: dict = {}
    for f in fps:
        got.setdefault(comps.get(signed(f), signed(f)), set()).add(signed(f))
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, got.values()))
    assert found.count() < 16 * len(fps) * (1 if bucket_rows > 8 else 40)  # spanning links, not all pairs


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 7])
def test_bit_sliced_distances(radius):
    rng = random.Random(radius)
    base = rng.getrandbits(64)
    values = np.array([near(rng, base, rng.randint(0, 9)) for _ in range(130)], dtype=np.uint64)
    masks = simhash.within(values[:64], simhash.bit_planes(values), radius)
    hits = np.unpackbits(np.ascontiguousarray(masks).view(np.uint8), axis=1, bitorder="little")[:, : len(values)]
    want = [[(int(a) ^ int(b)).bit_count() <= radius for b in values] for a in values[:64]]
    assert (hits.astype(bool) == np.array(want)).all()


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7), (None, 3), (500, 501)]
    edges += [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(150)]
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges if None not in e for x in e}
    for _ in range(len(label)):
        changed = False
        for a, b in edges:
            if a is not None and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
        if not changed:
            break
    alone = {a for a, b in edges if a == b}
    assert {k: v for k, v in label.items() if k not in alone or k in got} == got


def test_keep_one(spark):
    text = "one two three four five six seven"
    rows = [(3, text, "x"), (1, text, "y"), (1, text, "y"), (None, text, "z"), (2, "quite another text here", "w"), (None, "only null", "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in simhash.keep_one(docs).collect())
    assert got == [(False, 1, text), (False, 2, "quite another text here"), (True, 0, "only null")]
    assert simhash.keep_one(docs).columns == docs.columns


def test_decontamination_in_groups(spark):
    docs, bench = read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "benchmark")

    def run(**options):
        rows = decontam.annotate(docs, bench, "h", **options).select("doc_id", "h", decontam.n_hit(F.col("h")).alias("n")).collect()
        return sorted((r["doc_id"], r["h"]["n_words"], tuple(r["h"]["runs"]), tuple(r["h"]["items"]), r["h"]["spans"], r["n"]) for r in rows)

    one, many = run(), run(group_bytes=2000)
    assert one == many and any(r[5] for r in one)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for doc_id, _, runs, items, spans, n in one:
        assert bool(items) == bool(n)
        for span, lo, hi in zip([s for s in spans.split(",") if s], runs[::2], runs[1::2]):
            a, b = map(int, span.split(":"))
            assert brute.words3(text[doc_id][a:b]) == brute.words3(text[doc_id])[lo:hi]


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_token_blocks_are_stitched(spark, tmp_path, block):
    rng = random.Random(block)
    eos, want = 9, []
    for f in range(3):
        docs = [[rng.randint(0, 8) for _ in range(rng.choice([0, 0, 1, 2, 5, 40]))] for _ in range(30)]
        flat = [t for d in docs for t in [*d, eos]]
        if f == 1:
            docs.append([1, 2, 3])  # not closed
            flat += [1, 2, 3]
        np.array(flat, dtype="<u4").tofile(os.path.join(tmp_path, f"tokens-{f}.bin"))
        want += [(len(d), tuple(d[:4])) for d in docs]
    open(os.path.join(tmp_path, "tokens-empty.bin"), "w").close()
    got = tokens.count_documents(spark, str(tmp_path), dtype="<u4", eos=eos, heads=4, block=block).collect()
    assert sorted((r["n_tokens"], tuple(r["first"])) for r in got) == sorted(want)


def test_long_runs_of_white_space(monkeypatch):
    coder = tokens.encoding(tokens.read_ranks())
    monkeypatch.setattr(tokens, "_LONG_RUN", tokens.regex.compile(r"\p{White_Space}{3,}"))
    ends = ["x", " x", "\u00a0x", "1", "!", "", "\n", "'s", "\x1cy", "é"]
    for space in ("   ", "\n\n\n", " \n\t ", "\u00a0\u3000 ", "    \n", " " * 40):
        for before in ("", "word", "9", "?", "a  b"):
            for after in ends:
                text = before + space + after + space + before
                assert tokens.encode_text(coder, text) == coder.encode_ordinary(text), repr(text)
    monkeypatch.undo()
    for text in (" " * 1_000_000, "a" + " " * 1_000_000 + "b", "\n" * 300_000 + "c", "z" * 1_000_000):
        assert coder.decode(tokens.encode_text(coder, text)) == text


def test_a_very_long_text_does_not_end_the_job(spark):
    texts = ["a b", " " * 1_000_000, "x" * 1_000_000, "end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(docs, tokens.read_ranks()).collect()}
    coder = tokens.encoding(tokens.read_ranks())
    assert got == {i: len(tokens.encode_text(coder, t)) for i, t in enumerate(texts)}


@pytest.mark.parametrize("file_bytes", [1, 64, 500, 8 << 20])
def test_token_files_are_cut_by_bytes(spark, tmp_path, file_bytes):
    """A file holds at most so many bytes, or one document."""
    texts = ["a b"] * 40 + ["", None, "word " * 300, "x", "", "two words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    path = str(tmp_path / "tokens")
    tokens.write_token_files(docs, path, tokens.read_ranks(), file_bytes=file_bytes)
    files = [open(os.path.join(path, f), "rb").read() for f in os.listdir(path) if f.startswith("part-")]
    assert all(len(f) <= file_bytes or np.count_nonzero(np.frombuffer(f, tokens.DTYPE) == tokens.EOS) == 1 for f in files)
    assert file_bytes < 1000 or len(files) <= 2
    coder = tokens.encoding(tokens.read_ranks())
    got = tokens.token_counts(docs, tokens.read_ranks(), file_bytes=file_bytes).collect()
    assert sorted(map(tuple, got)) == [(i, len(coder.encode_ordinary(t or ""))) for i, t in enumerate(texts)]


def test_token_header_round_trip(spark):
    ids = [0, 1, -1, 2**63 - 1, -(2**63), 32767, 32768, None]
    df = spark.createDataFrame([(i, tokens.header(i)) for i in ids], "i long, first array<long>")
    assert all(r["i"] == r["got"] for r in df.withColumn("got", tokens.id_of(F.col("first"))).collect())


@pytest.mark.parametrize("min_count", [1, 2])
@pytest.mark.parametrize("hot,known,entries", [(1, 1, 10**9), (50, 60, 20_000), (2000, 1 << 20, 50_000), (5000, 1, 10**9)])
def test_lm_hot_and_joined_words(spark, monkeypatch, hot, known, entries, min_count):
    monkeypatch.setattr(lm, "HOT", hot)
    monkeypatch.setattr(lm, "KNOWN", known)
    docs = read_table(spark, SF_SMALL, "documents")
    rows = docs.collect()
    want = dict(zip([r["doc_id"] for r in rows], brute.backoff_scores([r["text"] for r in rows], min_count)))
    for r in lm.score(docs, entries=entries, min_count=min_count).collect():
        n, seen, score = want[r["doc_id"]]
        assert (r["n_words"], r["n_seen"]) == (n, seen)
        assert r["score"] == pytest.approx(score, abs=1e-6)


@pytest.mark.parametrize("hot,known,entries", [(1, 1, 10**9), (50, 60, 20_000), (2000, 1 << 20, 50_000), (5000, 1, 10**9)])
def test_lm_leaves_the_scored_word_out(spark, monkeypatch, hot, known, entries):
    monkeypatch.setattr(lm, "HOT", hot)
    monkeypatch.setattr(lm, "KNOWN", known)
    docs = read_table(spark, SF_SMALL, "documents")
    rows = docs.collect()
    want = dict(zip([r["doc_id"] for r in rows], brute.backoff_scores([r["text"] for r in rows], less=1)))
    for r in lm.score(docs, entries=entries, leave_out=True).collect():
        n, seen, score = want[r["doc_id"]]
        assert (r["n_words"], r["n_seen"]) == (n, seen)
        assert r["score"] == pytest.approx(score, abs=1e-6)


def test_lm_query_backs_off(spark, tmp_path):
    """A bigram that occurs nowhere else is scored by the backoff; one that
    does by its whole count but the scored occurrence."""
    rows = [(1, "a b"), (2, "A b"), (3, "c d"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["n_words"], r["n_seen"], r["score"]) for r in QUERIES["op2_lm_scores"](spark, str(tmp_path)).collect()}
    twice = (2, 2, round(math.log(1 / 2), 3))  # (mark, a): 1 of 2 others; (a, b): 1 of 1
    assert got == {1: twice, 2: twice, 3: (2, 0, round(2 * math.log(0.4 * 1 / 6), 3)), 4: (0, 0, 0.0)}


def test_mix_prefers_quality(spark):
    rows = [(i, "w " * 10, "hot" if i % 3 else f"s{i % 7}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weight = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    got = mixing.mix(docs, weight=weight, weights=(1,), share=0.5, bucket_rows=100).collect()
    taken = [sum(r["taken"] for r in got if r["source"] == "hot" and r["doc_id"] % 2 == p) for p in (0, 1)]
    assert taken[0] > 1.5 * taken[1] > 0
    for s in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1


def test_pii_redaction(spark):
    rows = [(1, "mail a@b.example.com now", 24), (2, None, 0), (3, "ünd 1.2.3.4 +1 (456) 555-2186.", 1), (4, "clean", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.redact(docs).collect()}
    assert got == {1: ("mail [EMAIL] now", 16), 2: (None, 0), 3: ("ünd [IP] [PHONE].", 17), 4: ("clean", 5)}


def test_pii_trees_add_spans(spark):
    """With enough positives and negatives the trees are fitted, and their
    SQL form scores like the model; phone numbers without a plus, which no
    base pattern takes, may be added, clean digits are not."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        n = [rng.randint(100, 999) for _ in range(3)]
        text = f"call +1 ({n[0]}) {n[1]}-{1000 + n[2]} today" if i % 3 == 0 else f"in {1900 + i % 99} they had {n[0]}{n[1]} of ab{n[2]}4{n[1]}cd"
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    booster = pii.fit(docs)
    assert booster.trees and booster.thresholds
    found = {r["doc_id"]: r["s"] for r in pii.find(docs, "s", booster).collect()}
    for i, text in rows:
        base = [tuple(x) for x in found[i]["base"]]
        assert set(base) <= {tuple(x) for x in found[i]["spans"]}
        assert bool(found[i]["spans"]) == (i % 3 == 0)


def test_pii_counts_every_candidate(spark):
    """No document and no candidate is left out of the fit: not beyond 40,000
    candidates, nor in a document of more than 1,000 base spans."""
    crowd = " ".join(f"u{i}@h{i}.example.com" for i in range(1_500))
    rows = [(0, crowd), (1, None), (None, "left in 1999 or so")] + [(i, f"in {1900 + i % 99} or so") for i in range(2, 45_002)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["label"]: r["n"] for r in pii.examples(docs).groupBy("label").agg(F.sum("n").alias("n")).collect()}
    assert got == {0.0: 45_001, 1.0: 1_500}


def test_pii_rewrites_across_chunks(spark, monkeypatch):
    """The rewritten text and its spans are the same in chunks of any size."""
    text = " ".join(f"é{i}.b@x{i}.com {i}.1.2.3 +1 (456) 555-{1000 + i}" for i in range(12)) + " end"
    df = spark.createDataFrame([(1, text), (2, "plain"), (3, "")], "id long, t string")

    def made(chunk):
        monkeypatch.setattr(pii, "CHUNK", chunk)
        r = pii.rewritten(F.col("t"), pii.base_spans(F.col("t")), F.col("id"))
        return sorted(tuple(x) for x in df.select("id", r["text"], r["spans"]).collect())

    want = made(1_000)
    assert made(1) == want and made(5) == want and [len(x[2]) for x in want] == [36, 0, 0]
    assert want[0][1].endswith(" end") and all(want[0][1][x["start"] : x["end"]].strip() for x in want[0][2])


def test_pii_adds_forms_beyond_the_base(spark):
    """Addresses and phone numbers in forms that no base pattern takes are
    added, once the corpus holds the kinds in their base form."""
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        a, b, c = (rng.randint(200, 999) for _ in range(3))
        who = rng.choice(("jane", "john.doe", "info", "k.lee")) + str(a)
        rows.append((i, (
            f"mail {who}@host{b}.example.com today", f"call +1 ({a}) {b}-{1000 + c} today",
            f"in {1900 + i % 99} they met at noon and had {a}{b} of {c} left", f"page {a} of {b}, look at it in {1900 + i % 99}",
        )[i % 4]))
    planted = {
        9001: ("mail ", "jane (at) example (dot) com"), 9002: ("call ", "(456) 555-2186"), 9003: ("mail ", "jane at example.com"),
        9004: ("mail ", "jane [at] example.com"),
    }
    docs = spark.createDataFrame(rows + [(i, a + b + " now") for i, (a, b) in planted.items()], "doc_id long, text string")
    found = {r["doc_id"]: r["l"] for r in pii.find(docs, "s", pii.fit(docs)).select("doc_id", pii.listed(F.col("s.spans")).alias("l")).collect()}
    for i, (a, b) in planted.items():
        assert found[i] == f"{'phone' if i == 9002 else 'email'}:{len(a)}:{len(a + b)}"
    assert all(not found[i] for i, _ in rows if i % 4 > 1)


def test_secret_novelty(spark):
    token = "Zk3vQ9xT7LmP2sWc8RbN4yHd"
    texts = [
        f"the api key for the service is {token} as agreed",  # random, sensitive
        "the picture of the service is Bq8wEr5tYu2iOp9aSd6fGh3j as agreed",  # no sensitive word
        "the secret of the house is houseofthehouseofthehouse as agreed",  # compresses
        "token = 'Lk7jHg4fDs1aPo0iUy9tRe6w'",  # a base span
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["l"] for r in secrets.find(docs, "s").select("doc_id", secrets.listed(F.col("s.spans")).alias("l")).collect()}
    at = texts[0].index(token)
    assert got == {0: f"novel:{at}:{at + len(token)}", 1: "", 2: "", 3: f"assign:0:{len(texts[3]) - 1}"}
    assert brute.secrets(texts[3])[1] == got[3]


def test_secret_recall(spark):
    """Short random tokens of each alphabet are found at random places."""
    docs = read_table(spark, SF_ORACLE, "documents")
    texts, rng = [r["text"] for r in docs.orderBy("doc_id").collect() if r["text"]], random.Random(23)
    rows = []
    for letters in ("0123456789abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/"):
        for n in (16, 24):
            for _ in range(400):
                text, token = rng.choice(texts), "1" + "".join(rng.choices(letters, k=n - 1))
                at = rng.randint(0, len(text))
                rows.append((len(rows), f"{text[:at]} bearer {token} {text[at:]}", f":{at + 8}:{at + 8 + n}"))
    planted = spark.createDataFrame(rows, "doc_id long, text string, want string")
    words = secrets.identifiers(docs)
    got = secrets.find(planted, "s", words=words).select("doc_id", "want", secrets.listed(F.col("s.spans")).alias("l")).collect()
    hits = [0] * 4
    for r in got:
        hits[r["doc_id"] // 400] += any(x.endswith(r["want"]) for x in r["l"].split(","))
    assert all(h >= 0.93 * 400 for h in hits), hits


def test_secret_calibration_takes_all_texts(spark, monkeypatch):
    """Every piece of every text gives a place for each alphabet: of more than
    400 texts, and beyond their first 4,096 characters."""
    monkeypatch.setattr(secrets, "TRIES", 1)
    texts = [f"text {i} of the house and its garden" for i in range(600)] + ["word " * 2_000, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = secrets.shares(docs, ["house"]).groupBy("class").agg(F.sum("count").alias("n")).collect()
    assert {r["class"]: r["n"] for r in got} == {name: 600 + 3 for name in secrets.ALPHABETS}
    # the share that 98 % (90 %) of the random tokens reach
    found, least = secrets.shares(docs, ["house"]).collect(), secrets.calibrated(docs, ["house"])
    for (name, n), share in least.items():
        own = [(r["share"], r["count"]) for r in found if (r["class"], r["length"]) == (name, n)]
        recall = 0.9 if name.startswith("letters") else 0.98
        assert sum(c for x, c in own if x >= share) >= recall * sum(c for _, c in own)


def test_secret_in_copies(spark):
    """Neither copies nor near copies of a page make its secret a word of the
    dictionary; the secret of each is found."""
    tokens = ["Zk3vQ9xT7LmP2sWc8RbN4yHd", "Hy7dRw2qKp5nVx8cMt3gLs6b"]
    rows = [f"the api key for the service is {tokens[0]} as agreed"] * 50
    rows += [f"the api key for the house {i} is {tokens[1]} as agreed" for i in range(50)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    words = secrets.identifiers(docs)
    assert "agreed" in words and not set(tokens) & set(words)
    assert "house" in words and "service" not in words  # service is in one text only
    got = {r["doc_id"]: r["l"] for r in secrets.find(docs, "s").select("doc_id", secrets.listed(F.col("s.spans")).alias("l")).collect()}
    assert all(got[i] == f"novel:{t.index(tokens[i // 50])}:{t.index(tokens[i // 50]) + 24}" for i, t in enumerate(rows))


def test_redirects_spread_blocks(spark):
    rules = urls.rules_table(spark, [("bad.com", "/", "block"), ("good.com", "/", "allow"), ("bad.com", "/", "block")])
    link = "<link rel='canonical' href='{}'>".format
    pages = spark.createDataFrame(
        [(1, "http://a.net/", link("http://BAD.com/x")), (2, "https://b.net/p?q=1", None), (3, "http://c.net/", link("http://good.com/")),
         (4, "http://d.net/", None), (5, "http://hub.net/", None), (6, "http://www.bad.com/", "")] + [(10 + i, f"http://n{i}.net/", link("/../hub")) for i in range(3)],
        "page_id long, url string, html string",
    )
    more = [("http://b.net/p?q=1", "http://a.net/"), ("http://c.net/", "http://d.net/"), ("http://d.net/", "http://bad.com/y"), (None, "http://x.net/")]
    more += [(f"http://h{i}.net/", "http://hub.net/") for i in range(200)] + [("http://h7.net/", "http://bad.com/z")]
    redirects = spark.createDataFrame(more, "from_url string, to_url string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages, rules, redirects).collect()}
    # 3 and 4 share a component with both; the allowed one takes precedence
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "block", 6: "block", 10: "allow", 11: "allow", 12: "allow"}


def test_relative_targets_link_in_code_and_in_sql(spark, tmp_path):
    rules = [("bad.com", "/", "block")]
    link, refresh = "<link rel=canonical href='{}'>".format, "<meta http-equiv=refresh content='0; url={}'>".format
    bad = link("http://bad.com/x")
    pages = [
        ("http://s.net/a/b/c", link("../x/./y")), ("http://s.net/a/x/y", bad),
        ("http://s.net/list?id=4", link("?id=5")), ("http://S.net/list?id=5#f", bad),
        ("http://s.net/q", refresh("?")), ("https://s.net/q?", bad),
        ("http://s.net/deep/../p/", ""), ("http://s.net/p/", bad),
        ("http://s.net/up", link("../../../top/..")), ("http://s.net/", bad),
        ("http://s.net/end/.", ""), ("http://s.net/end/", bad),
        ("http://t.net/a.b/..c/.d", link("e")), ("http://t.net/a.b/..c/e", bad),
        ("http://u.net", link("?z")), ("http://u.net?z", bad),
        ("http://free.net/x?id=5", link("#top")), ("http://free.net/y", link("mailto:a@b.c")), ("http://free.net/..", link("z")),
    ]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    df.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r["verdict"] for r in urls.judge(df, urls.rules_table(spark, rules)).collect()}
    assert [pages[i][0] for i, v in sorted(got.items()) if v == "allow"] == [u for u, _ in pages if "free.net" in u]
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    cur = con.execute(oracle.url_filter(rules))
    names = [d[0] for d in cur.description]
    assert {r[names.index("page_id")]: r[names.index("verdict")] for r in cur.fetchall()} == got


def test_toxicity_held_out(spark):
    """Rows that are never learned from are told apart."""
    docs, labels = read_table(spark, SF_ORACLE, "documents"), read_table(spark, SF_ORACLE, "labels")
    got = toxicity.scored(docs, labels, "s").join(labels, "doc_id").select("doc_id", "s", "toxic", toxicity.held_out(F.col("doc_id")).alias("h"))
    rows = got.collect()
    hits = [(r["s"] >= 0.5) == bool(r["toxic"]) for r in rows if r["h"]]
    assert sum(hits) / len(hits) >= 0.95
    pos, neg = ([r["s"] for r in rows if r["h"] and r["toxic"] == t] for t in (1, 0))
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc >= 0.8
    assert all(r["s"] < 0.5 for r in rows if r["h"] and not r["toxic"])


@pytest.mark.parametrize("seed", [1, 2])
def test_label_model(spark, seed):
    """Accuracies, correlations, weights and posteriors of the plain model."""
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        bad = rng.random() < 0.2
        fired = {v for v, p in enumerate((0.7, 0.5, 0.3, 0.05)) if rng.random() < (p if bad else 0.03)}
        fired |= {4} if 0 in fired and rng.random() < 0.9 else set()  # a voter that follows another
        rows.append((sorted(fired), int(bad) if rng.random() < 0.5 else None))
    rows += [([], None)] * 20
    df = spark.createDataFrame(rows, "votes array<int>, toxic int")
    model = toxicity.fit_label_model(df, 6)
    prior, accuracy, rho, weight, posterior = brute.label_model(rows, 6)
    assert model.prior == pytest.approx(prior)
    assert model.accuracy.tolist() == pytest.approx(accuracy)
    assert model.correlation.ravel().tolist() == pytest.approx([x for r in rho for x in r])
    assert model.weight.tolist() == pytest.approx(weight)
    assert weight[0] < 1 and weight[1] == 1
    got = df.select("votes", model.posterior(F.col("votes")).alias("p")).collect()
    assert [r["p"] for r in got] == pytest.approx([posterior(r["votes"]) for r in got])


def test_toxicity_without_labels(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.without_toxic(docs, labels).count() == docs.count()


def test_toxicity_collapses_copies_only(spark):
    """Texts that share words are counted one by one; exact and near copies
    of a text once."""
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(3000)]
    texts = ["scum " + " ".join(rng.choices(vocabulary, k=60)) for _ in range(40)]
    copied = rng.choices(vocabulary, k=2000)
    texts += [" ".join(copied)] * 5 + [" ".join([*copied[:-1], w]) for w in vocabulary[:10]]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(1000 + i, " ".join(rng.choices(vocabulary, k=60)), 0) for i in range(200)]
    mined = toxicity.mine(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert (mined.n_toxic, mined.n_clean) == (41, 200)
    assert any(p.startswith("scum") for p in mined.patterns)


def test_spotsigs_order_by_ranges(spark):
    """Many id ranges give the same neighbours as one."""
    docs = read_table(spark, SF_SMALL, "documents")
    one, many = (
        sorted((r["doc_id"], r["next_text"]) for r in spotsigs.with_next(docs, range_rows=n).collect()) for n in (10**6, 7)
    )
    assert one == many and len(one) == docs.count()


def test_spotsigs_likeness(spark):
    rows = [([1, 2, 3], [2, 3, 4]), ([], []), ([], [1]), ([1], list(range(1, 11)))]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    full = [r[0] for r in df.select(spotsigs.likeness(F.col("a"), F.col("b"))).collect()]
    assert full == [0.5, 1.0, 0.0, 0.1]
    assert [r[0] for r in df.select(spotsigs.likeness(F.col("a"), F.col("b"), 0.8)).collect()] == [0.5, 1.0, 0.0, 0.0]


def test_spotsigs_classes(spark):
    """Alike documents far apart in id order share a class: the classes are
    those of all pairs, hot signatures or none."""
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    rows = []
    for g in range(25):
        base = [w for _ in range(rng.randint(3, 60)) for w in ("the", *rng.choices(words, k=3))]
        for _ in range(rng.randint(1, 8)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append(" ".join(text[: len(text) - rng.randint(0, 9)] + ["the common tail here"] * (g % 2)))
    rng.shuffle(rows)
    rows += ["", None, rows[0]]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    sigs = {r["doc_id"]: set(r["s"]) for r in spotsigs.with_signatures(docs, "s", F.col("text")).collect()}
    want = {i: i for i in sigs}
    alike = [(i, j) for i in sigs for j in range(i) if sigs[i] == sigs[j] or len(sigs[i] & sigs[j]) >= 0.8 * len(sigs[i] | sigs[j])]
    for _ in sigs:
        for i, j in alike:
            want[i] = want[j] = min(want[i], want[j])
    assert 25 < len(set(want.values())) < len(want) - 20
    for hot in (0, 5, 1000):
        assert {r["doc_id"]: r["class_id"] for r in spotsigs.classes(docs, hot=hot).collect()} == want
