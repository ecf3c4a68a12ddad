from difflib import SequenceMatcher

import pytest
from hypothesis import given
from hypothesis import strategies as st
from kinspark.functions import indic, lexicon, metrics, prepare, text
from kinspark.operators import blocking
from kinspark.sources import delimited
from pyspark.sql import functions as F

words = st.text(alphabet="abc ", max_size=9)


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@given(words, words)
def test_lcs_and_ratio(a, b):
    assert metrics.lcs_length(a, b) == plain_lcs(a, b)
    assert metrics.indel_ratio(a, b) == metrics.indel_ratio(b, a)
    assert metrics.partial_ratio(a, b) >= metrics.indel_ratio(a, b) or len(a) != len(b)


@given(words, words)
def test_bounds(a, b):
    for name, (f, _) in metrics.MEASURES.items():
        assert f(a, a) == {"jaro_winkler": 1.0, "lcs": len(a), "osa": 0}.get(name, 100.0)
        assert f(a, b) >= 0
    assert metrics.osa_distance(a, b) <= max(len(a), len(b))


@given(words, words, st.integers(0, 2))
def test_within_is_the_edit_distance(a, b, most):
    assert prepare.within(a, b, most) == (metrics.osa_distance(a, b) <= most)


def test_osa_and_sets():
    assert metrics.osa_distance("ca", "abc") == 3
    assert metrics.osa_distance("ltd", "ldt") == 1
    assert metrics.token_set_ratio("blue sea", "sea blue inn") == 100
    assert metrics.token_sort_ratio("blue sea", "sea blue") == 100
    assert SequenceMatcher(None, "abc", "abc").ratio() * 100 == metrics.indel_ratio("abc", "abc")


CLEAN = {
    "Hôtel du Parc S.A.R.L": "hotel du parc sarl", "https://www.tall-trees.co.in/shop": "tall trees shop", "": "", None: "", "Zoë & Ann's": "zoe and anns", "room204": "room 204", "a1": "a1",
    "ﬁne Ｗine №5 ½": "fine wine no5 1 2", "x@y": "x at y", "U.S.A. trade": "usa trade", "J. Doe": "j doe", "मुंबई Café": "munbai cafe", "İzmir_Ünal": "izmir unal", "９８ rue": "98 rue",
}


def test_clean(spark):
    df = spark.createDataFrame([(k,) for k in CLEAN], "t string")
    got = {r.t: r.c for r in df.select("t", text.clean(F.col("t")).alias("c")).collect()}
    assert got == CLEAN


def test_figures_for_letters(spark):
    want = {"h0tel": "hotel", "6reen tea": "green tea", "21st St": "21st St", "1st": "1st", "5th ave": "5th ave", "b1ue 10": "blue 10", "0ak5": "oak5"}
    df = spark.createDataFrame([(k,) for k in want], "t string")
    assert {r.t: r.c for r in df.select("t", text.unleet(F.col("t")).alias("c")).collect()} == want


RECORDS = [
    # name, address, country; core, legal, house, street, street type, unit, postal
    ("Lotus Exports Pvt. Ltd.", "Plot 12, Gandhi Marg, Pune, Maharashtra 411001", "India", "lotus ekshports", "pvtltd", "12", "gandhi", "marg", "", "411001"),
    ("श्री गणेश ट्रेडर्स प्राइवेट लिमिटेड", "", "India", "shri ganesh tredars", "pvtltd", "", "", "", "", ""),
    ("M/s Kapoor (India) Motors LLP", None, "India", "kapur motors", "llp", "", "", "", "", ""),
    ("LLC Harbor Lights", "P.O. Box 77, 14 Second Street Apt 9, Dover, New York 10001", "US", "harbor lights", "llc", "14", "2nd", "st", "9", "10001"),
    ("Incorprated Oak Mills", "TX 75001, Plano, 880 N Elm Ave", "US", "oak mills", "inc", "880", "elm", "ave", "", "75001"),
    ("Boulangerie Petit sSARL", "7 ter rue des Lilas BP 99 69003 Lyon Cedex 03", "France", "boulangerie petit", "sarl", "7", "lilas", "rue", "", "69003"),
    ("The Company", "null", "US", "the company", "", "", "", "", "", ""),
    ("Depot III Co", "0042 Mill Rd", " us ", "depot 3", "co", "42", "mill", "rd", "", ""),
    (None, None, None, "", "", "", "", "", "", ""),
]


def test_prepared_records(spark):
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(RECORDS)], "id int, name string, address string, country string")
    got = {r.id: r for r in prepare.prepare(df).collect()}
    for i, r in enumerate(RECORDS):
        x = got[i]
        assert (x.core, x.legal, x.house, x.street, x.street_type, x.unit, x.postal) == r[3:], r
    assert got[7].core_toks == ["depot", "3"] and got[7].name_nums == ["3"] and got[7].initials == "d3" and got[7].phon == "DPT" and got[7].sdx_first == "D130"
    assert got[1].translit and not got[0].translit and "po" not in got[3].addr_toks and got[5].addr_n.endswith("69003 lyon")


def test_indic_scripts():
    assert indic.romanise("कमल পদ্ম") == "kamal padma" and indic.romanise("मित्र") == "mitra" and indic.romanise("१२।") == "12 "
    assert indic.romanise("दिल्ली", {"दिल्ली": "delhi"}).strip() == "delhi" and indic.romanise("plain") == "plain"


def test_lexicon(spark):
    pairs = [(f"{a} {b}", f"{c} {d}", e) for e in range(3) for a, b, c, d in [("নীল", "সফটওয়্যার", "Nil", "Software"), ("সোনার", "লিমিটেড", "Sonar", "Limited")]]
    pairs += [("একা লিমিটেড", "Eka Limited", 9), (None, "x", 1), ("plain", "plain", 2)]
    df = spark.createDataFrame(pairs, "native_text string, latin_text string, ent int")
    lex = {r.native: r.latin for r in lexicon.kept(lexicon.mined(df)).collect()}
    assert lex[indic.native_key("সফটওয়্যার")] == "software" and lex[indic.native_key("লিমিটেড")] == "limited" and "একা" not in lex
    assert lexicon.align([("k", "pashchimbanga")], ["pashchim", "banga"]) == [("k", "pashchim banga")] and lexicon.align([], ["a"]) == []
    s1 = spark.createDataFrame([("S1-1", "Nil Software", "Road 1", "India")], "id string, name string, address string, country string")
    rec = spark.createDataFrame([("S2-1", "নীল সফটওয়্যার", "", "India"), ("S2-2", "Nil", "", "India")], "id string, name string, address string, country string")
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-2")], "s1_id string, rec_id string")
    assert lexicon.pairs_of(s1, rec, truth).count() == 2 and lexicon.learn(s1, rec, truth) == {}


def test_columns(spark):
    df = spark.createDataFrame([("phoods", "12 Rd", "", "x")], "w string, h string, a string, b string")
    row = df.select(text.india_phonetic(F.col("w")).alias("i"), text.leading_int(F.col("h")).alias("n"), text.leading_int(F.col("w")).alias("none"), text.missing_eq(F.col("a"), F.col("b")).alias("eq"), text.simple_key(F.lit("A-b 1")).alias("k")).first()
    assert tuple(row) == ("fuds", 12, None, None, "ab1")
    places = [("1 Elm, Reno, Nevada 89501", "US", "us:nv"), ("Reno NV", "us", "us:nv"), ("12 quai, Lyon, Rhône", "France", ""), ("a, Corse", "France", "france:cor"), ("a, MH", "India", ""), ("x, New Delhi 110001", "India", "india:dl"), (None, "US", ""), ("Texas", "Peru", "")]
    got = spark.createDataFrame(places, "a string, c string, s string").select(text.state_of(F.col("a"), F.col("c")).alias("got"), "s").collect()
    assert [r.got for r in got] == [r.s for r in got]


def test_id_lists_and_truth(spark, tmp_path):
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "id string")
    pairs = spark.createDataFrame([("S1-3", "S3-9", 0.9), ("S1-1", "S2-5", 0.2), ("S1-1", "S2-5", 0.8)], "s1_id string, rec_id string, score double")
    assert sorted(map(tuple, delimited.id_lists(s1, pairs).collect())) == [("S1-1", "S2-5"), ("S1-2", ""), ("S1-3", "S3-9")]
    ordered = spark.createDataFrame([("S1-3",), ("S1-1",), ("S1-2",)], "id string").coalesce(1)
    assert delimited.write_id_lists(delimited.with_order(ordered), pairs, str(tmp_path / "lists")) == 2
    assert [r.source1_entity_id for r in delimited.read_table(spark, str(tmp_path / "lists")).collect()] == ["S1-3", "S1-1", "S1-2"]
    abc = spark.createDataFrame([("A",), ("B",), ("C",)], "id string")
    want = [("A", "x"), ("A", "y"), ("B", None), ("C", None)]
    for name, head in (("h.tsv", "source1_entity_id\tmatched_entity_ids\n"), ("n.tsv", "")):
        (tmp_path / name).write_text(head + "A\tx, y\nB\t\nA\ty\n")
        truth = delimited.load_ground_truth(spark, str(tmp_path / name), abc)
        assert sorted(map(tuple, truth.collect()), key=str) == want
    (tmp_path / "u.tsv").write_text("A\tx\nZ\tq\nZ\tr\n")  # a later unknown id is no header
    truth = delimited.load_ground_truth(spark, str(tmp_path / "u.tsv"), abc)
    assert truth.filter("s1_id = 'Z'").count() == 2 and delimited.unknown_entities(truth, abc).count() == 1


def test_source(spark, tmp_path):
    p = tmp_path / "s.tsv"
    p.write_text('entity_id\tbusiness_name\tstreet\taddr\tcountry\n S2-1 \tBob "x"\tHill\t1 Rd\t US \nS2-1\tAnn\t\t\tUS\n')
    got = delimited.load_source(spark, str(p), 2)
    assert sorted(map(tuple, got.collect())) == [("S2-1", "Ann", "", "US", 2), ("S2-1", 'Bob "x"', "1 Rd, Hill", "US", 2)]
    assert delimited.duplicate_ids(got).count() == 1
    assert delimited.count_rows(spark, str(p)) == 2


def test_split_and_sinks(spark, tmp_path):
    row = "entity_id\tname\taddress\tcountry\n{}\tAnn\t1 Rd\tUS\n"
    for name, key in (("train_source1.tsv", "S1-1"), ("train_source2.tsv", "S2-1"), ("src3.txt", "S3-1")):
        (tmp_path / name).write_text(row.format(key))
    (tmp_path / "source_1_truth.tsv").write_text("S1-1\tS2-1,S3-1\n")
    assert delimited.find_file(spark, str(tmp_path), "s1").endswith("train_source1.tsv")
    split = delimited.load_split(spark, str(tmp_path), with_truth=True)
    assert split.s1.count() == 1 and {r.id for r in split.rec.collect()} == {"S2-1", "S3-1"} and split.truth.count() == 2
    with pytest.raises(FileNotFoundError):
        delimited.load_split(spark, str(tmp_path / "none"))
    scores = spark.createDataFrame([("S1-1", "S2-1", 0.5, True)], "s1 string, rec string, p double, taken boolean")
    delimited.write_scores(scores, str(tmp_path / "scores"))
    assert tuple(delimited.read_table(spark, str(tmp_path / "scores")).first()) == ("S1-1", "S2-1", "0.5", "1")
    delimited.write_reports({"curve": scores}, {"f": 0.5}, str(tmp_path / "reports"))
    assert spark.read.text(str(tmp_path / "reports" / "report")).first().value == '{"f": 0.5}'
    assert delimited.read_table(spark, str(tmp_path / "reports" / "curve")).count() == 1


def test_keys(spark):
    cols = "ckey string, id long, core_toks array<string>, compact string, addr_toks array<string>, addr_nums array<string>, house string, street string, postal string, first_tok string, meta_first string, initials string"
    r = spark.createDataFrame([("us", 1, ["blue", "sea", "2"], "bluesea2", ["9", "oak", "st", "dover"], ["9"], "9", "oak", "", "blue", "BL", "bs2"), ("us", 2, [], "", [], [], "", "", "", "", "", "")], cols)
    keys = blocking.record_keys(r)
    assert sorted(x.key for x in keys.collect()) == sorted(["c|bluesea2", "p|blue|sea", "t|blue", "t|sea", "hs|9|oak", "mh|BL|9", "sf|oak|blue", "ab|oak|st", "ab|st|dover", "ac|bs2|9", "na|bluesea2|dover", "fa|blue|dover"])
    sizes = spark.createDataFrame([("us", 2)], "ckey string, n long")
    hit = blocking.key_overlap(keys, keys, blocking.pruned_keys(keys, sizes)).collect()
    assert [(x.rec, x.s1, x.key_rank) for x in hit] == [(1, 1, 1)]
    one = spark.createDataFrame([(1, 1, 3)], "rec int, s1 int, rnk int")
    assert [tuple(x) for x in blocking.candidate_union({"key": one, "knn": one.filter("rnk > 9")}, {"key": 16, "knn": 11}).collect()] == [(1, 1, 3, 11, 1)]
