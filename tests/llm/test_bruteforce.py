"""The corpus operators and every stage of the pipeline against plain versions over all rows of small tables."""

import hashlib
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from kinspark.llm import common, decontaminate, fingerprints, html_text, ngram_join, pii, quality, queries, secrets_scan, sentencepiece_codec, sharding
from pyspark.sql import functions as F

from .test_operators import brute_components, text


def words_of(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute_leaks(docs, items):
    """(doc, item) of all alignments of which a window of twelve words (or the shorter item) has enough equal ones."""
    out = set()
    for d, t in docs:
        w = words_of(t)
        for i, s in items:
            x = words_of(s)
            n = min(12, len(x))
            if len(x) < 5:
                continue
            for at in range(1 - len(x), len(w)):
                equal = [0 <= at + j < len(w) and w[at + j] == x[j] for j in range(len(x))]
                if any(sum(equal[k : k + n]) >= -(-n * 8 // 10) for k in range(len(x) - n + 1)):
                    out.add((d, i))
    return out


@pytest.mark.parametrize("seeds", [None, 0])
def test_decontamination(spark, monkeypatch, seeds):
    if seeds is not None:
        monkeypatch.setattr(decontaminate, "SEEDS", seeds)
    r = random.Random(4)
    items = [(n, text(n, n)) for n in (3, 5, 6, 7, 8, 9, 10, 11, 12, 13, 20, 31)] + [(100, None), (101, "")]
    docs = [(0, None), (1, ""), (2, text(9, 200))]
    for n, s in items[:-2]:
        for changed in range(5):
            w = s.split()
            for k in r.sample(range(len(w)), min(changed, len(w))):
                w[k] = "zz"
            docs.append((len(docs), f"{text(50 + n, r.randint(0, 9))} {' '.join(w)} {text(70 + n, r.randint(0, 9))}"))
    a, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(2), spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(docs, items)
    got = {(x.doc_id, x.item_id) for x in decontaminate.find(a, b).collect()}
    # of items of full length, an alignment needs twelve words with two substitutions at most, which the masks always find
    assert got == want and len(want) > 20
    assert {x.doc_id for x in decontaminate.clean(a, b).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_ring(spark):
    n = 700
    df = spark.createDataFrame([(i, text(i, 3)) for i in range(n)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in sharding.assign(df, shards=5, nodes=4).collect()}
    place = {r.doc_id: r.p for r in df.select("doc_id", F.xxhash64(F.lit("ring"), "doc_id").alias("p")).collect()}
    nodes = sharding.ring(5, 4)
    arcs = [[i for i in place if sharding.arc_of(place[i], nodes) == a] for a in range(len(nodes))]
    left, room, went = [len(a) for a in arcs], sharding.capacities(n, 5, 0.0), [Counter() for _ in arcs]
    for step in range(5):  # every arc offers what is left to the step-th shard clockwise
        for a in range(len(nodes)):
            clockwise = list(dict.fromkeys(nodes[(a + k) % len(nodes)][1] for k in range(len(nodes))))
            s = clockwise[step]
            k = min(left[a], room[s])
            left[a], room[s] = left[a] - k, room[s] - k
            went[a][s] += k
    assert not any(left)
    for a, ids in enumerate(arcs):
        assert Counter(got[i].shard for i in ids) == +went[a]


def test_ring_with_slack_moves_little(spark):
    n = 900
    df = spark.createDataFrame([(i, "x") for i in range(n)], "doc_id long, text string")
    before, after = ({r.doc_id: r.shard for r in sharding.assign(df, shards=s, slack=0.25).collect()} for s in (8, 9))
    for shards, of in ((8, before), (9, after)):
        assert max(Counter(of.values()).values()) <= sharding.capacities(n, shards, 0.25)[0]
    moved = [i for i in before if before[i] != after[i]]
    assert len(moved) <= 2 * n / 9 and sum(after[i] == 8 for i in moved) >= 0.6 * len(moved)
    assert sharding.capacities(10, 4, 0.1) == [3] * 4 and sharding.capacities(100, 4, 0.0) == [25] * 4 and sharding.capacities(40, 4, 0.1) == [11] * 4


def test_quality_forward_pass():
    net = quality.new_net(3)
    for t in (b"", b"a", bytes(range(256)) * 3, text(1, 900).encode()):
        total, parts = quality.CHUNK, []
        for at in range(0, max(1, len(t)), total):
            piece = t[at : at + total + quality.WIDTH - quality.STRIDE].ljust(total + quality.WIDTH - quality.STRIDE, b"\0")
            acts = [[sum(float(net.table[w, piece[i + w], f]) for w in range(quality.WIDTH)) + float(net.bias[f]) for i in range(0, total - 1, quality.STRIDE)] for f in range(quality.FILTERS)]
            parts.append([max(0.0, max(a)) for a in acts])
        x = np.concatenate([np.mean(parts, axis=0), np.max(parts, axis=0)])
        assert quality.score(net, [b"other", t])[1] == pytest.approx(1 / (1 + np.exp(-(x @ net.out + net.shift[0]))), abs=1e-5)


def test_quality_does_not_depend_on_the_order_of_rows(spark):
    docs = spark.createDataFrame([(i % 50, text(i, 20)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 50, i % 2) for i in range(120)], "doc_id long, quality int")
    rows = quality.training_rows(docs, labels)
    assert rows == quality.training_rows(docs.repartition(7), labels.repartition(5)) and rows


BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
}


def test_secrets_as_plain_expressions_find_them():
    r = random.Random(8)
    pieces = ["password", "TOKEN", "api_key", "ApiKey", "secret", "passwd", "AKIA", "akia", "=", ":", " ", "'", '"', "é", "😀", "0123456789abcdef", "ABCDEFGH12", "abcdef", "x", "\n", "=="]
    for _ in range(3000):
        t = "".join(r.choices(pieces, k=r.randint(0, 25)))
        want = sorted((m.start(), list(BASE).index(k), m.end()) for k, (p, ok) in BASE.items() for m in p.finditer(t) if ok(m))
        assert [x for x in secrets_scan.scan(t) if x[0] in BASE] == [(list(BASE)[k], a, b) for a, k, b in want], t


def sketch_of(t):
    w = [x for x in re.split(r"[ \t-\r]+", t) if x]
    hashes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in w]
    runs = [hashes[i : i + 3] for i in range(max(1, len(w) - 2))] if w else []
    out = set()
    for run in runs:
        h = 42
        for x in run:
            h = xxhash.xxh64(struct.pack("<Q", x), seed=h).intdigest()
        out.add(h >> 33)
    low = sorted(v for v in out if v < 1 << 29)
    return low or sorted(out)[:1]


def likeness_of(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def test_fingerprints(spark):
    ids = [-(2**63), 2**63 - 1, *range(40), 7, None, None]
    rows = [(i, None if k == 5 else "" if k == 6 else text(k % 30, 1 + 7 * (k % 13))) for k, i in enumerate(ids)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, _place int, _bucket int").repartition(3)
    hashed = lambda t: int.from_bytes(xxhash.xxh64(t.encode(), seed=42).intdigest().to_bytes(8, "big"), "big", signed=True)
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, ~r[0] if r[0] is not None else 0, hashed(r[1])))
    want = Counter()
    for (i, t), (_, nxt) in zip(order, [*order[1:], order[0]]):
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        a, e, b = sketch_of(t), sketch_of(edited), sketch_of(nxt)
        as_text = lambda s: "".join(f"{v:08x}" for v in s)
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), as_text(a), as_text(e), round(likeness_of(a, e), 9), round(likeness_of(a, b), 9)] += 1
    for neighbours in (500, 4):
        fingerprints.NEIGHBOURS, old = neighbours, fingerprints.NEIGHBOURS
        try:
            got = fingerprints.fingerprint_documents(df).collect()
        finally:
            fingerprints.NEIGHBOURS = old
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want


def test_sketches_of_unions(spark):
    texts = ["", "one", "two words", text(1, 4), text(2, 5), text(3, 60), text(4, 200)]
    df = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    s = df.select("a", "b", fingerprints.sketch(F.col("a")).alias("x"), fingerprints.sketch(F.col("b")).alias("y"))
    for r in s.select("a", "b", fingerprints.merged(F.col("x"), F.col("y")).alias("m"), fingerprints.containment(F.col("x"), F.col("y")).alias("c")).collect():
        both = set(sketch_of(r.a)) | set(sketch_of(r.b))
        low = sorted(v for v in both if v < 1 << 29)
        assert list(r.m) == (low or sorted(both)[:1])
        if r.a == r.b:
            assert r.c == 1.0


def test_surrogates_leave_no_long_value(spark):
    mail, name = "a" * 90 + "@example.com", "Q" + "uent" * 15
    t = f"Write {mail} to Mr {name}; {name} is there, and x@y.com."
    got = pii.replace_documents(spark.createDataFrame([(1, t)], "doc_id long, text string"), "k")
    new = got.first().text
    assert "aaaa" not in new and "uentuent" not in new and "x@y.com" not in new
    assert "surrogates" not in got._jdf.queryExecution().toString()
    a, b = re.fullmatch(r"Write \S+ to Mr (\w+); (\w+) is there, and \S+\.", new).groups()
    assert a == b


def test_html_blocks_in_any_nesting():
    r, story = random.Random(2), "It is the story of a man and of the sea and of all that was in it for him and for her."
    for _ in range(60):
        deep = "".join(r.choice(["<div>", "<section>", "<b>", "<span>", "<ul><li>", "<table><tr><td>"]) for _ in range(r.randint(0, 90)))
        junk = f"<{(j := r.choice(['nav', 'footer', 'aside', 'script', 'style']))}>{'<span>' * r.randint(0, 90)}the of and to in is that it was for{'<i>' * r.randint(0, 9)}</{j}>"
        assert html_text.main_text(f"<body>{junk}{deep}<p>{story}</p>{junk}<p>{story} Again.</p>{junk}") == f"{story}\n{story} Again."


def folder(spark, path, docs, labels, bench):
    kinds = {"documents": "doc_id long, text string, lang string, source string, n_chars long, row string, d int, _t int", "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for name, rows in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        spark.createDataFrame(rows, kinds[name]).repartition(2).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_pipeline_stage_by_stage(spark, tmp_path):
    import corpus_pipeline

    good = lambda i, n=40: text(i, n)
    junk = lambda i: " ".join(random.Random(i).choices(["***", "$$$", "!!!", "###"], k=40))
    bench = [(1, good(900, 25)), (2, None), (3, good(901, 6))]
    texts = [good(i) for i in range(60)] + [junk(i) for i in range(25)] + [good(3), good(3) + " w1", good(4), "", None]
    texts += [good(70) + " " + bench[0][1], good(71) + " " + bench[2][1], good(72) + " password=abcdefghijkl12 end", good(73, 1500)]
    docs = [(i, t, "en", "s", None if t is None else len(t), "r", 1, 2) for i, t in enumerate(texts)] + [(None, good(74), "en", "s", 1, "r", 1, 2)]
    labels = [(i, int(i < 60), 0) for i in range(85)]
    sf = folder(spark, tmp_path / "sf", docs, labels, bench)
    rows = common.table(spark, sf, "documents")
    kept = Counter(map(tuple, rows.collect()))
    net = quality.fit(rows, common.table(spark, sf, "labels"))
    model = queries.piece_model()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, rows, sf).write.parquet(str(tmp_path / name))
        rows = spark.read.parquet(str(tmp_path / name))
        got = Counter(map(lambda r: tuple(tuple(x) if isinstance(x, list) else x for x in r), rows.collect()))
        if name.startswith("quality"):
            want = Counter({r: n for r, n in kept.items() if quality.score(net, [(r[1] or "").encode()])[0] >= 0.3})
            assert len(want) < len(kept)
        elif name.startswith("n-gram"):
            every = [r for r, n in kept.items() for _ in range(n)]
            groups = brute_components([(r[0], r[1]) for r in every], 5, 80)
            first = {k[2] for k in groups}
            want = Counter(r for r in every if not ngram_join.shingle_sets([(r[1] or "").encode()], 5)[0].size or r[0] in first)
            assert len(want) < len(kept)
        elif name.startswith("benchmark"):
            leaks = {d for d, _ in brute_leaks([(r, r[1]) for r in kept], bench)}
            want = Counter({r: n for r, n in kept.items() if r not in leaks})
            assert leaks
        elif name.startswith("secret"):
            new = {r: secrets_scan.redact(r[1], secrets_scan.scan(r[1])) for r in kept}
            want = Counter()
            for r, n in kept.items():
                want[r if new[r] == r[1] else (r[0], new[r], *r[2:4], len(new[r]), *r[5:])] += n
            assert any("[assign]" in (t or "") for t in new.values())
        else:
            lib, want = sentencepiece_codec.codec(model).library, Counter()
            for r, n in kept.items():
                ids = (1, *lib.encode(r[1] or ""), 2)
                want[r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(lib.decode(list(ids)).encode()).hexdigest(), ids] += n
        assert got == want, name
        kept = got
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()) == Counter({k: n for (k, *_), n in ((r, m) for r, m in kept.items())})


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    sf = folder(spark, tmp_path / "sf", [], [], [])
    assert corpus_pipeline.run(spark, sf).collect() == []


def test_columns_kept_may_have_any_name(spark):
    df = spark.createDataFrame([(1, 2, 3, "Mr Lee, token=abcdefghijkl <p>x"), (1, 2, 3, None)], "_t int, t int, _by int, text string")
    keep, model = ("_t", "t", "_by"), queries.piece_model()
    for out in (pii.replace_documents(df, "k", keep=keep), secrets_scan.scan_documents(df, keep=keep), sentencepiece_codec.encode_documents(df, model, keep=keep), html_text.extract_pages(df, keep=keep, html_col="text"), quality.score_documents(df, 0.5, keep=keep)):
        assert out.columns[:3] == list(keep) and [tuple(r)[:3] for r in out.collect()] == [(1, 2, 3)] * 2


def test_scratch_of_others_stays(spark, tmp_path):
    df = spark.range(5)
    mine, theirs = [], common.materialise(df, "theirs")
    with common.scratch(mine):
        common.materialise(df, "mine")
    common.delete(spark, mine)
    assert not mine and theirs.count() == 5
