"""The corpus operators against brute force on small tables: nulls, empty and long texts, repeated rows, empty tables."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import pytest
from kinspark.llm import decontaminate, fingerprints, html_text, ngram_join, pii, quality, secrets_scan, sentencepiece_codec, sharding, warc
from pyspark.sql import functions as F

WORDS = [f"w{i}" for i in range(300)]


def text(seed, n):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


@pytest.fixture(scope="module")
def docs(spark):
    base = text(1, 120)
    rows = [(1, base), (2, base), (2, base), (3, base + " tail"), (4, ""), (5, None), (None, text(2, 40)), (6, "one two"), (7, "ONE  two\n"), (8, text(3, 3000)), (9, "é" * 5000), (10, text(4, 60)), (11, text(4, 60).replace("w1", "w2", 1))]
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, shard string").repartition(3)


def sets(t, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_components(rows, n, percent):
    s = [sets(t, n) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in group}
    return Counter((r[0], len(x), least[g]) for r, x, g in zip(rows, s, group))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_ngram_join(spark, docs, n, percent):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = ngram_join.similar(docs, n, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, n, percent)


def test_ngram_join_of_edited_copies(spark):
    base, rows = text(9, 150).split(), []
    for i in range(60):
        r, w = random.Random(i), list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = f"e{r.random()}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ngram_join.similar(df, 4, 85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 4, 85)
    kept = {r.doc_id for r in ngram_join.deduplicate(df, 4, 85).collect()}
    assert kept == {k[2] for k in brute_components(rows, 4, 85)}


def chains(seed, groups=6, links=9):
    """Texts that drift away from each other step by step, so that no pivot is near all of a group."""
    r, rows = random.Random(seed), []
    for g in range(groups):
        w = text(100 * seed + g, 140).split()
        for k in range(links):
            w = [f"n{r.random()}" if r.random() < 0.012 else x for x in w]
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("limits", [{}, {"KEYS": 0, "COLUMNS": 0, "ROWS": 4, "BLOCK": 2000, "STAR": 2}])
def test_ngram_join_of_chains(spark, monkeypatch, limits):
    """Also beyond every size up to which something is broadcast or one block."""
    for k, v in limits.items():
        monkeypatch.setattr(ngram_join, k, v)
    formed = []
    tiles = ngram_join._tiles
    monkeypatch.setattr(ngram_join, "_tiles", lambda *a: formed.append(1) or tiles(*a))
    rows = chains(3)
    got = ngram_join.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 4, 85).collect()
    want = brute_components(rows, 4, 85)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert formed and 6 <= len({k[2] for k in want}) < len(rows)


def test_prefix_bound_loses_no_pair(spark):
    """Every pair that reaches the similarity passes the bound on search columns; most others do not."""
    rows = chains(5, 4, 6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = ngram_join._sets(df, 4).cache()
    postings = ngram_join._postings(df, ngram_join._column_counts(made), 4, 85)
    cols = postings.groupBy("node").agg(F.collect_set("h").alias("hs"), *(F.max(c).alias(c) for c in ("n", "wr", "wh")))
    node = {r.doc_id: r.node for r in made.filter("slice is null").collect()}
    pairs = spark.createDataFrame([(node[a], node[b]) for a, _ in rows for b, _ in rows if node[a] != node[b]], "a long, b long").distinct()
    kept = {(r.a, r.b) for r in ngram_join._possible(pairs, cols, 85).collect()}
    s = {i: sets(t, 4) for i, t in rows}
    near = {(node[a], node[b]) for a in s for b in s if node[a] != node[b] and 100 * len(s[a] & s[b]) >= 85 * len(s[a] | s[b])}
    assert near and near <= kept and len(kept) < pairs.count() / 2


def test_deduplicate_keeps_columns_of_any_name(spark):
    rows = [(1, text(1, 60), 7, 8, 9, "r"), (2, text(1, 60), 1, 2, 3, "s"), (3, "", 4, 5, 6, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _x int, _d int, x long, row string")
    got = ngram_join.deduplicate(df)
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == [rows[0], rows[2]]
    bench = spark.createDataFrame([(5, text(1, 60))], "item_id long, text string")
    named = df.withColumnsRenamed({"_x": "_dx", "x": "found_d"})
    assert sorted(map(tuple, decontaminate.clean(named, bench).collect())) == [rows[2]]


def test_ngram_join_of_nothing(docs):
    assert ngram_join.similar(docs.limit(0)).collect() == []


def test_deduplicate_keeps_one_row(docs):
    got = Counter(r.doc_id for r in ngram_join.deduplicate(docs).collect())
    assert got[1] == 1 and not got[2] and got[4] == 1 and got[5] == 1 and got[None] == 1


def test_warc(spark, tmp_path):
    long = "é" * 600
    df = spark.createDataFrame([(1, "u", long), (7, "v\r\n", long), (7, "w", long), (None, "n", long), (4, "s", "short"), (5, "s", "short"), (8, None, None)], "page_id long, url string, html string")
    index = warc.write_archives(df, str(tmp_path / "a"))
    got = warc.read_archives(spark, index, payloads=True).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in got) == Counter([(1, "revisit", 7), (7, "response", None), (7, "revisit", 7), (None, "revisit", 7), (4, "response", None), (5, "response", None), (8, "response", None)])
    assert len({r.record_id for r in got}) == 7
    assert all(r.payload_digest == hashlib.sha1(long.encode()).hexdigest() for r in got if r.payload_bytes == 1200)
    for e in index.collect():
        assert warc.fetch(e)[0]["warc-record-id"] == e["record_id"]
    assert warc.archive_pages(df.limit(0)).collect() == []


def test_sharding(spark, docs):
    got = sharding.shard_documents(docs, 4).collect()
    load = Counter(r.shard for r in got)
    assert len(got) == docs.count() and max(load.values()) - min(load.values()) <= 1
    for s in load:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(load[s]))
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    assert sharding.shard_documents(docs.limit(0)).collect() == []


def test_sentencepiece(docs):
    from kinspark.llm import queries

    model = queries.piece_model()
    lib = sentencepiece_codec.codec(model).library
    rows = Counter((r.doc_id, r.text or "") for r in docs.collect())
    want = Counter()
    for (i, t), n in rows.items():
        ids = [1, *lib.encode(t), 2]
        want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()] += n
    assert Counter(map(tuple, sentencepiece_codec.encode_documents(docs, model, with_ids=False).collect())) == want


def test_agenda_on_random_texts():
    from kinspark.llm import queries

    c = sentencepiece_codec.codec(queries.piece_model())
    r = random.Random(5)
    for _ in range(3000):
        t = "".join(r.choice("aeiourstn .,'²\n▁(\"*&é中😀") for _ in range(r.randint(0, 80)))
        ids = [1, *c.library.encode(t), 2]
        assert c.encode(t) == struct.pack(f"<{len(ids)}I", *ids)


def test_decontamination(spark, docs):
    item = text(77, 30)
    edited = item.split()
    edited[4] = edited[15] = edited[22] = "changed"
    df = docs.select("doc_id", "text").union(spark.createDataFrame([(100, text(5, 50) + " " + item.upper() + "!"), (101, " ".join(edited) + " " + text(6, 20)), (102, " ".join(item.split()[:8]))], "doc_id long, text string"))
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (1, item)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find(df, bench).collect()} == {(100, 1), (101, 1)}
    assert decontaminate.clean(df, bench).count() == df.count() - 2
    assert decontaminate.find(df, bench.limit(0)).collect() == []


def test_secrets(docs):
    body = "a1B2" * 7 + "xy"
    token = f"ghp_{body}" + secrets_scan.base62_crc(body.encode()).decode()
    t = f"é token = 'abcdefghijkl' PASSWORD:short {token} ghp_{'0' * 36} AKIA{'A' * 14} {'0af' * 6}"
    assert [k for k, _, _ in secrets_scan.scan(t)] == ["assign", "github", "hex", "access", "hex"]
    assert t[slice(*secrets_scan.scan(t)[0][1:])].startswith("token")
    assert secrets_scan.scan(None) == [] and secrets_scan.scan_documents(docs).count() == docs.count()
    assert "abcdefghijkl" not in secrets_scan.redact(t, secrets_scan.scan(t))


def test_pii(spark):
    t = "Mr. John Smith met Frau Müller, Mr Smith; (212) 555-1234. Card 4111 1111 1111 1111, no 4111 1111 1111 1112. John.S@Ex.com, john.s@ex.com 10.0.0.1."
    got = {r.doc_id: r for r in pii.replace_documents(spark.createDataFrame([(1, t), (2, None), (3, ""), (4, "plain"), (4, "plain")], "doc_id long, text string"), "k").collect()}
    for x in ("John", "Smith", "Müller", "212", "4111 1111 1111 1111", "S@Ex", "10.0.0.1"):
        assert x not in got[1].text
    names = re.findall(r"Mr\.? (?:\w+ )?(\w+)[ ;]", got[1].text)
    mails = re.findall(r"\S+@[\w.]+\w", got[1].text)
    assert names[0] == names[1] and mails[0].lower() == mails[1] and "4111 1111 1111 1112" in got[1].text
    assert got[2].text is None and got[3].text == "" and got[4].text == "plain"


def test_pii_finds_a_surrogate_for_every_value(spark, monkeypatch):
    monkeypatch.setattr(pii, "ATTEMPTS", 2)
    names = [a + b for a in "BCDFGHJKLMNPRSTVWXYZ" for b in "aeiou"]  # more than half of the forms of their length
    odd = ["xxx@xxx.com", "x@y.com", "xx@qq.com", "漢字東@仮名京.com", "한글@글.kr", "สม@ชา.th", "٣٤@٥.org", "𠀁𠀂@𠀃.com", "-@-.com"]
    rows = [(i, f"Mr {n} or Mr {n.upper()}") for i, n in enumerate(names)] + [(1000 + i, x) for i, x in enumerate(odd)] + [(2000, "Mr Xy, Mr Արամ"), (2001, "call +12222 or +1 2223")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.replace_documents(df, "k").collect()}
    new = [re.fullmatch(r"Mr (\w+) or Mr (\w+)", got[i]).groups() for i in range(len(names))]
    assert all(a.upper() == b and a[0].isupper() and a[1:].islower() for a, b in new)
    assert len({a for a, _ in new}) == len(names) and not {a for a, _ in new} & {*names, "Xy"}
    assert all(got[1000 + i] != x and got[1000 + i].count("@") == 1 and got[1000 + i][-3:] == x[-3:] for i, x in enumerate(odd))
    assert not {c for i in (3, 4, 7) for c in got[1000 + i]} & set("漢字東仮名京한𠀁𠀂𠀃")
    assert "Xy" not in got[2000] and "Արամ" not in got[2000] and "2222" not in got[2001]


def test_pii_names_are_whole_and_followed(spark):
    t = ["Dr J. Smith met Mr John Quincy Adams. He is old. Later Smith, SMITH and John Smith left; Adams's dog and J. Smith stayed.", "Smith and Adams are not titled here.", "Mr Lee a@b.com John stays, Prof. J.R.R. Tolkien's book, a smith."]
    got = {r.doc_id: r for r in pii.replace_documents(spark.createDataFrame(list(enumerate(t)), "doc_id long, text string"), "k").collect()}
    m = re.fullmatch(r"Dr (\w)\. (\w+) met Mr (\w+) (\w+) (\w+)\. He is old\. Later (\w+), (\w+) and (\w+) (\w+) left; (\w+)'s dog and (\w)\. (\w+) stayed\.", got[0].text).groups()
    j, smith, john, quincy, adams = m[:5]
    assert m[5:] == (smith, smith.upper(), john, smith, adams, j, smith) and got[0].n_replaced == 12
    assert j != "J" and len({smith, john, quincy, adams, "Smith", "John", "Quincy", "Adams"}) == 8
    assert got[1].text == t[1] and got[1].n_replaced == 0
    m = re.fullmatch(r"Mr (\w+) \S+@\S+ John stays, Prof\. (\w)\.(\w)\.(\w)\. (\w+)'s book, a smith\.", got[2].text).groups()
    assert m[0] != "Lee" and "J" != m[1] == j and "R" != m[2] == m[3] and m[4] != "Tolkien"


def test_fingerprints(docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs.filter("doc_id is not null").dropDuplicates(["doc_id"])).collect()}
    for k, (i, t) in enumerate(rows):
        half, nxt = len(t) // 2, rows[(k + 1) % len(rows)][1]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()
    assert got[1].fingerprint == got[2].fingerprint and got[2].near_next == 1.0 and got[4].fingerprint == ""
    assert fingerprints.fingerprint_documents(docs.limit(0)).collect() == []


def test_quality_holds_out(spark):
    rows = [(i, text(i, 40) + (" *** $$$" * 10 if i % 3 == 0 else "")) for i in range(400)]
    df = spark.createDataFrame([*rows, (1000, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i, _ in rows], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.score_documents(df, quality.fit(df, labels)).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.5) == (i % 3 != 0) for i in held) >= 0.95 * len(held) and 0 <= got[1000] <= 1
    assert quality.fit(df, labels.limit(0)) == 1.0


def test_html():
    page = '<html><body><nav><a href="/">home page of all</a></nav><div class="ad">Buy the best of all in the world today.</div><article><h1>A title</h1><p>It is the story of a man and the sea &amp; of all that was in it for him.<br>Next   line.<p>End</article><div id="comments"><p>I was the first to say that it is the best of all the articles here.</p></div><footer>&copy; us</footer>'
    assert html_text.main_text(page) == "A title\nIt is the story of a man and the sea & of all that was in it for him.\nNext line.\nEnd"
    assert html_text.main_text(None) == "" and html_text.main_text("<p>The cut of the page is in the middle of the <a hre") in ("", "The cut of the page is in the middle of the")


def test_html_end_tags_at_any_depth():
    story = "<p>It is the story of a man and the sea and of all that was in it for him and for the ones who were with her.</p>"
    text = "It is the story of a man and the sea and of all that was in it for him and for the ones who were with her."
    for opened in ("<select>" + "<option>x" * 100 + "</select>", "<nav><ul>" + "<li><a href=x>home</a>" * 100 + "</ul></nav>", "<ul class=menu>" + "<li><i>home" * 100 + "</ul>", "<table class=menu>" + "<tr><td><i>x<td>y" * 100 + "</table>", "<dl class=menu>" + "<dt><i>x<dd>y" * 100 + "</dl>"):
        assert html_text.main_text(f"<body>{opened}{story}") == text
    page = "<body><article>" + story + "<p>of<b>it" * 100 + "</article>" + "<p>Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi.</p>"
    assert [b[2] for b in html_text.blocks(page)][-1] is False
    nested = "<body><ul class=menu><li>one<ul><li>two</ul><li>three</ul>" + story
    assert html_text.main_text(nested) == text and len(html_text.blocks(nested)) == 4
    assert html_text.blocks("<b><article><p>one<b>two<p>three</b><p>four")[-1] == ("four", 0.0, True, False)
    many = "<body>" + "<div>" * 200 + "<nav>" + "<i>" * 200 + "home</nav>" + story
    assert html_text.main_text(many) == text


@pytest.mark.parametrize("words", [
    "Il vecchio pescatore era uscito da solo con la sua barca e non aveva preso un pesce per molti giorni di seguito",
    "O velho pescador saía sozinho com o seu barco e não apanhava um peixe havia muitos dias e muitas noites",
    "De oude visser ging alleen met zijn boot de zee op en hij had in vele dagen niet een vis gevangen",
    "Старый рыбак вышел в море один на своей лодке и за много дней не поймал ни одной рыбы, но он не сдавался",
    "一个老渔夫独自驾着小船在海上捕鱼已经很多天没有捕到一条鱼了但是他并没有放弃每天清晨他都会再次出海直到夜晚才回到岸边邻居们都劝他休息他却总是笑着摇头说明天一定会有好运气",
    "Mzee mvuvi alikwenda peke yake baharini ndani ya mashua yake siku nyingi bila kupata samaki hata mmoja lakini",
])
def test_html_in_other_languages(words):
    page = "<body><nav><a href=x>home</a></nav>" + "".join(f"<div>{words} {i}.</div>" for i in range(4)) + f"<div><a href=x>{words}</a></div>"
    assert html_text.main_text(page) == "\n".join(f"{words} {i}." for i in range(4))


def test_pipeline_rows(spark, sf):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, sf)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert 0 < rows.count() <= spark.read.parquet(f"{sf}/documents.parquet").count()
    assert rows.filter(F.size("ids") != F.col("n_tokens")).count() == 0
