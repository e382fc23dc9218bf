"""Sources, tables, loads and whole jobs."""

import datetime
import math
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from murmur import fixed, session
from murmur.operators import similarity as S
from murmur.plans import incremental as I, pipeline, report as RP, terms as TM
from murmur.session import scratch_dir
from murmur.sources import dictionaries as D, feedback as FB
from murmur.sources.tables import Tables
from murmur.streaming.tagging import clean_stream, load_stream

SURVEY = fixed.SOURCE_COLUMNS[fixed.SURVEY]
AGENT = f"Agent (iPhone) {fixed.VERSION_MARKERS[0]}10.3 X"


def quoted(values):
    return ",".join('"' + v.replace('"', '""') + '"' for v in values)


def survey_csv(rows):
    header = [SURVEY["date"], SURVEY["device"], *SURVEY["original"], SURVEY["country"]]
    return "\n".join([quoted(header)] + [quoted(r) for r in rows]) + "\n"


def test_source_detection():
    survey = [c for c in SURVEY.values() if isinstance(c, str) and c]
    assert FB.identify_source(survey) == fixed.SURVEY  # the list columns are not checked
    assert FB.identify_source(["Date", "Version", "Store", "Rating", "Country"]) == fixed.STORE_REVIEWS
    assert FB.identify_source(survey[:-1]) == "Unknown"


def test_reading_a_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(survey_csv([
        ["2018-05-10", AGENT, "fast", "", "USA"], ["2018-05-11", "Linux iPad", "", 'it "broke",\nbadly', "France"],
    ]))
    (tmp_path / "in" / "b.csv").write_text(survey_csv([["2018-05-12", "", "", "", ""]]))
    (tmp_path / "in" / "c.csv").write_text('Date,Version,Store,Rating,Subject,Body,Country\n2018-05-13,12.1,iOS,5,Hi,"there",USA\n')
    (tmp_path / "in" / "notes.xlsx").write_text("ignored")
    rows = {str(r.date): r for r in FB.read_feedback(spark, str(tmp_path / "in")).collect()}
    assert len(rows) == 4
    first = rows["2018-05-10"]
    assert (first.store, first.device, first.version, first.original, first.country) == ("iOS", "iPhone", 10.3, "fast", "United States")
    assert first.translated == "" and first.rating == ""
    assert rows["2018-05-11"].original == 'it "broke",\nbadly' and rows["2018-05-11"].device == "Linux"
    assert (rows["2018-05-12"].device, rows["2018-05-12"].store, rows["2018-05-12"].version) == ("Unknown", "", 0.0)
    other = rows["2018-05-13"]
    assert (other.original, other.rating, other.version, other.translated) == ("Hi. there", "5", 12.1, None)
    assert sorted(r.line.path[-5:] for r in FB.read_feedback(spark, str(tmp_path / "in")).collect()) == ["a.csv", "a.csv", "b.csv", "c.csv"]
    (tmp_path / "in" / "d.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no known source"):
        FB.read_feedback(spark, str(tmp_path / "in"))


def test_layouts_mixed_in_a_sub_folder(spark, tmp_path):
    folder = tmp_path / "in" / "deep"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text('Date,Version,Store,Rating,Subject,Body,Country\n2018-05-13,12.1,iOS,5,Hi,"there",USA\n')
    (folder / "b.csv").write_text('Country,Date,Version,Store,Rating,Subject,Body\nFrance,2018-05-14,11.2,iOS,4,Ho,"you",\n')
    (folder / "c.csv").write_text(survey_csv([["2018-05-15", AGENT, "fast", "", "USA"]]))
    (folder / "_hidden.csv").write_text("x\n1\n")
    reviews = spark.createDataFrame([("2018-05-16", "3.5", "Web", "1", "P", "q", "USA")], "Date string, Version string, Store string, Rating string, Subject string, Body string, Country string")
    reviews.coalesce(1).write.parquet(str(tmp_path / "in" / "more"))
    for multi_line in (True, False):
        got = {str(r.date): r for r in FB.read_feedback(spark, str(tmp_path / "in"), multi_line).collect()}
        assert [(got[f"2018-05-{d}"].country, got[f"2018-05-{d}"].original) for d in (13, 14, 15, 16)] == [
            ("United States", "Hi. there"), ("France", "Ho. you"), ("United States", "fast"), ("United States", "P. q")]
        assert got["2018-05-14"].version == 11.2 and got["2018-05-14"].store == "iOS"


def test_dictionaries(spark, tmp_path):
    path = tmp_path / "cat.csv"
    path.write_text('﻿Store,Tier,Feature,Component,Keywords\niOS,1,F,C,"a, b"\niOS,,G,C,\nDesktop,,H,D,c\n', encoding="utf-8")
    df = D.read_categories(spark, str(path))
    assert [r.feature for r in df.orderBy("line").collect()] == ["F", "G", "H"]
    assert sorted(r.keyword for r in D.listed_keywords(df, "store").collect()) == ["a", "b", "c"]
    words = tmp_path / "stop.txt"
    words.write_text("the\nThe\nareas\nlet's\n")
    assert D.stop_words(spark, str(words)) == ["The", "areas", "let", "s", "the"]
    assert sorted(r.word for r in D.read_words(spark, str(words), ["Extra"]).collect()) == ["", "area", "extra", "let", "the"]
    D.write_words(D.unique_words(spark.createDataFrame([(2, "b"), (1, "a"), (0, "b")], "i int, w string"), "w", "i"), str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["b", "a"]


def test_dates_are_strict_and_orphans_stay(spark):
    fb = spark.createDataFrame([(1, "2018-01-01"), (2, "2018-01-02"), (3, "2018-01-03")], "id long, date string")
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (9, "d")], "id long, x string")
    new, (kept,) = I.newer_than(fb, [child], F.lit(datetime.date(2018, 1, 2)))
    assert [r.id for r in new.collect()] == [3]
    assert sorted(r.id for r in kept.collect()) == [3, 9]


@pytest.mark.parametrize("top, want", [
    (0, 20180510000000), (20180509000100, 20180510000000), (20180510000100, 20180510000101), (5, 20180510000000),
    (20180509000000 + 4_500_000, 20180513500001), (20180510000000 + 4_500_000, 20180514500001),
])
def test_batch_base(spark, top, want):
    base = I.batch_base(F.lit(top).cast("long"), F.lit(datetime.date(2018, 5, 10)))
    assert spark.range(1).select(base).first()[0] == want


def test_tables(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    tables.create()
    tables.create()
    assert I.high_water_mark(tables.read("reviews")).first()[0] == datetime.date(1999, 1, 1)
    tables.append("key_issue", spark.createDataFrame([("7", "x")], "id string, key_issue string"))
    tables.append("key_issue", spark.createDataFrame([("8", "x")], "id string, key_issue string"), "unfinished")
    tables.register("murmur_test")
    seen = lambda: [r.id for r in spark.table("murmur_test.key_issue").orderBy("id").collect()]
    assert seen() == ["7"] and spark.table("murmur_test.reviews").count() == 0
    assert tables.find("key_issue", "7").count() == 1 and tables.find("key_issue", "8").count() == 0
    assert tables.read_with_numbers("key_issue").first().id == 7
    tables.append("key_issue", spark.createDataFrame([("9", "x"), ("x9", "y")], "id string, key_issue string"))
    assert seen() == ["7", "9", "x9"] and tables.find("key_issue", "x9").count() == 1
    before = tables.read("key_issue")
    tables.clear("key_issue")
    assert tables.read("key_issue").count() == 0 and seen() == []
    assert before.count() == 3  # who has read the entry before still finds its files
    assert spark.table("murmur_test.reviews").columns == tables.read("reviews").columns


FEEDBACK = "id long, store string, device string, source string, country string, date date, version double, rating string, original string, translated string, sentiment string, spam int, verb_phrases array<string>, noun_phrases array<string>"


def feedback_of(spark, days, first=0):
    rows = [(first + i, "s", "d", "src", "", d, 1.0, "", f"text {first + i}", f"text {first + i}" if i % 4 != 3 else None, "", 0, [], []) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, FEEDBACK)
    categories = df.selectExpr("id", "'f' AS feature", "'c' AS component", "array('a') AS actions")
    return df, categories, df.selectExpr("id", "'i' AS issue")


def test_loads_are_lossless(spark, tmp_path):
    tables, today = Tables(spark, str(tmp_path / "t")), datetime.date(2018, 5, 10)
    day = lambda n: datetime.date(2018, 5, n)
    batch = feedback_of(spark, [day(1), day(2), None, day(2), day(2)])
    read = lambda name: sorted(r.id for r in tables.read(name).collect())
    assert I.load(tables, *batch, today, "a") == 20180510000000
    want = ["20180510000000", "20180510000001", "20180510000004"]
    # The fourth has no translation and the third no date: neither leaves children behind.
    assert read("reviews") == read("categorization") == read("key_issue") == want
    assert read("undated") == ["20180510000002"]
    # The same batch again does nothing; the same rows under another name are old.
    assert I.load(tables, *batch, today, "a") == 20180510000000
    assert I.load(tables, *batch, today, "b") == 20180510000005
    assert read("reviews") == want and read("undated") == ["20180510000002"]
    # A batch cut short before its entry in the log is not read, and replaced when it comes again.
    tables.append("reviews", tables.read("reviews"), "c")
    assert read("reviews") == want
    assert I.load(tables, *feedback_of(spark, [day(3)], 9), today, "c") == 20180510000005
    assert read("reviews") == [*want, "20180510000014"] == read("key_issue")
    # A day later than the last, after a very large batch.
    tables.enter("large", 20180510000015, 20180515500000, day(4))
    assert I.load(tables, *feedback_of(spark, [day(5)]), datetime.date(2018, 5, 13)) == 20180515500001


def test_headers_are_read_from_the_first_bytes(spark, tmp_path):
    cases = {
        "plain.csv": ("a,b\n" + "1,2\n" * 400_000, ("a", "b")),
        "mark.csv": ("\ufeffa,é\r\n1,2", ("a", "é")),
        "quoted.csv": ('"a ""x"", y","two\nlines"\n1,2\n', ('a "x", y', "two\nlines")),
        "wide.csv": (",".join(f"column {i}" for i in range(2000)) + "\n", tuple(f"column {i}" for i in range(2000))),
        "alone.csv": ("a,b", ("a", "b")),
        "empty.csv": ("", ()),
    }
    for name, (text, _) in cases.items():
        (tmp_path / name).write_text(text, newline="")
    stats = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = stats()
    for name, (_, header) in cases.items():
        assert FB._header(spark, str(tmp_path / name)) == header
    assert stats() - before < 200_000 < (tmp_path / "plain.csv").stat().st_size


def test_two_loads_at_once_are_one_after_the_other(spark, tmp_path):
    """Eight loads that all begin before any has finished: IDs are disjoint, nothing is lost."""
    tables, today = Tables(spark, str(tmp_path / "t")), datetime.date(2018, 5, 10)
    tables.create()
    day = datetime.date(2018, 5, 1)
    batches = [feedback_of(spark, [day] * 8, 10 * i) for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        bases = list(pool.map(lambda i: I.load(tables, *batches[i], today, f"b{i}", datetime.date(2000, 1, 1)), range(4)))
    assert len(set(bases)) == 4
    ids = [r.id for r in tables.read("reviews").collect()]
    assert len(ids) == len(set(ids)) == 4 * 6
    assert sorted(ids) == sorted(r.id for r in tables.read("key_issue").collect())
    log = sorted((r.first_id, r.top) for r in tables.log().filter("first_id IS NOT NULL").collect())
    assert all(a[1] < b[0] for a, b in zip(log, log[1:]))
    assert sorted(r.number for r in tables.log().collect()) == list(range(5))


def test_the_mark_of_a_load_at_once_counts(spark, tmp_path, monkeypatch):
    """A load that loses its entry is decided anew after the one that took it."""
    tables, today = Tables(spark, str(tmp_path / "t")), datetime.date(2018, 5, 10)
    same = feedback_of(spark, [datetime.date(2018, 5, 1)] * 3)
    real, other = Tables.write, []

    def write(self, name, rows, part):
        real(self, name, rows, part)
        if name == "reviews" and not other:
            other.append(part)
            I.load(self, *same, today, "other")

    monkeypatch.setattr(Tables, "write", write)
    I.load(tables, *same, today, "first")
    assert tables.read("reviews").count() == 3  # its rows are as old as those of the other
    assert {r.batch for r in tables.log().collect()} == {"", "other", "first"}
    assert len(list((tmp_path / "t" / "reviews").glob("part=first-*"))) == 1  # the lost part is gone


def test_an_entry_is_written_once(spark, tmp_path):
    path = str(tmp_path / "log" / "1.json")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: session.create_new(spark, path, f"{i}\n"), range(8)))
    assert sum(won) == 1 and open(path).read() == f"{won.index(True)}\n"
    assert [p.name for p in (tmp_path / "log").iterdir()] == ["1.json"]
    # As on file systems that aren't local.
    target = spark._jvm.org.apache.hadoop.fs.Path("file:" + str(tmp_path / "far" / "1.json"))
    assert [session._rename_new(spark, target, t) for t in ("a", "b")] == [True, False]
    assert (tmp_path / "far" / "1.json").read_text() == "a"
    assert [p.name for p in (tmp_path / "far").iterdir() if not p.name.endswith(".crc")] == ["1.json"]


def test_compaction_keeps_rows_and_readers(spark, tmp_path):
    tables, today = Tables(spark, str(tmp_path / "t")), datetime.date(2018, 5, 10)
    I.load(tables, *feedback_of(spark, [datetime.date(2018, 5, 1)] * 5), today, "a")
    for i in range(20):
        tables.append("key_issue", spark.createDataFrame([(str(100 + i), "x"), (str(500 - i), "y")], "id string, key_issue string"))
    rows = lambda name: sorted(map(tuple, tables.read(name).collect()))
    before, old = {n: rows(n) for n in ("reviews", "key_issue", "undated")}, tables.read("key_issue")
    seen = tables.snapshot()
    assert tables.compact(rows_a_file=10)
    assert {n: rows(n) for n in before} == before
    after = tables.snapshot()
    assert [len(p) for p in after.parts.values()] == [1] * len(after.parts)
    assert (after.top, after.mark) == (seen.top, seen.mark) and after.top is not None
    assert len(tables.files_with("key_issue", "105")) == 1 and tables.find("key_issue", "105").count() == 1
    assert tables.files_with("key_issue", "300") == [] or tables.find("key_issue", "300").count() == 0
    assert "105" in [r.id for r in old.collect()]
    # Loads go on from the merged state, under the same names as before.
    assert I.load(tables, *feedback_of(spark, [datetime.date(2018, 5, 1)] * 5), today, "a") == 20180510000000
    assert I.load(tables, *feedback_of(spark, [datetime.date(2018, 5, 2)]), today, "b") == after.top + 1
    # A compaction that a load overtakes changes nothing.
    stale = tables.snapshot()
    tables.append("key_issue", spark.createDataFrame([("7", "z")], "id string, key_issue string"))
    tables.snapshot = lambda: stale
    assert not tables.compact()
    del tables.snapshot
    assert ("7", "z") in rows("key_issue")
    assert tables.vacuum(hours=1) == 0
    whole = {n: rows(n) for n in before}
    assert tables.vacuum(hours=0) > 20
    assert {n: rows(n) for n in before} == whole


def test_compaction_bounds_the_bytes_of_a_file(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"))
    I.load(tables, *feedback_of(spark, [datetime.date(2018, 5, 1)] * 9), datetime.date(2018, 5, 10), "a")
    before = sorted(map(tuple, tables.read("reviews").collect()))
    assert tables.compact(bytes_a_file=1000)
    assert len(tables.read("reviews").inputFiles()) > 1
    assert sorted(map(tuple, tables.read("reviews").collect())) == before


def test_compaction_leaves_what_is_merged(spark, tmp_path):
    """Only tables that got rows since are written again; other bounds, and a table that lost
    its rows, are not taken for merged."""
    tables = Tables(spark, str(tmp_path / "t"), {"a": "id string, x string", "b": "x string, n long"})
    tables.create()
    tables.append("a", spark.createDataFrame([("2", None), (None, "u"), ("1", "v"), ("1", "v")], "id string, x string"))
    tables.append("b", spark.createDataFrame([(None, 1), ("z", 2)], "x string, n long"))
    rows = lambda: [sorted(map(str, tables.read(name).collect())) for name in ("a", "b")]
    parts = lambda: tables.snapshot().parts
    before = rows()
    assert tables.compact() and rows() == before
    first, number = parts(), tables.snapshot().number
    assert tables.compact() and (parts(), rows()) == (first, before)
    assert tables.snapshot().number == number + 1 and len(list((tmp_path / "t" / "a").glob("part=*"))) == 3
    tables.append("b", spark.createDataFrame([("y", 3)], "x string, n long"))
    more = rows()
    assert tables.compact() and rows() == more
    assert parts()["a"] == first["a"] and len(parts()["b"]) == 1 and parts()["b"] != first["b"]
    second = parts()
    assert tables.compact(rows_a_file=1) and rows() == more
    assert not set(parts()["a"]) & set(second["a"]) and not set(parts()["b"]) & set(second["b"])
    tables.clear("a")
    assert tables.compact(rows_a_file=1) and rows() == [[], more[1]] and len(parts()["a"]) == 1
    tables.vacuum(hours=0)
    assert rows() == [[], more[1]]


def test_a_load_of_new_texts_makes_its_feedback_once(spark, tmp_path):
    feedback, categories, issues = feedback_of(spark, [datetime.date(2018, 5, 1)] * 6)
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        made.add(1)
        return text

    tables = Tables(spark, str(tmp_path / "t"))
    feedback = feedback.withColumn("original", counted("original"))
    I.load(tables, feedback, categories, issues, datetime.date(2018, 5, 10), "a", datetime.date(2000, 1, 1), once=True)
    assert made.value == 6 and tables.read("reviews").count() == 5  # one is not translated


def test_texts_come_once_over_loads(spark, tmp_path):
    tables, day = Tables(spark, str(tmp_path / "t")), datetime.date(2018, 5, 1)
    for k, (batch, days) in enumerate([(range(0, 4), [day] * 4), (range(2, 6), [day] * 4), (range(0, 7), [day] * 7)]):
        feedback, categories, issues = feedback_of(spark, days, batch[0])
        I.load(tables, feedback, categories, issues, datetime.date(2018, 5, 10), f"b{k}", datetime.date(2000, 1, 1), once=True)
    texts = sorted(r.original_reviews for r in tables.read("reviews").collect())
    assert len(texts) == len(set(texts))
    assert set(texts) >= {"text 0", "text 1", "text 2", "text 4"}
    assert tables.read("key_issue").count() == tables.read("reviews").count()
    tables.compact()
    I.load(tables, *feedback_of(spark, [day] * 4), datetime.date(2018, 5, 10), "again", datetime.date(2000, 1, 1), once=True)
    assert sorted(r.original_reviews for r in tables.read("reviews").collect()) == texts


def test_term_tables_over_loads(spark, tmp_path):
    texts = [(i, "s" if i % 3 else "t", [f"w{j}" for j in range(i % 5 + 1)] * 2) for i in range(30)]
    bags = lambda rows: spark.createDataFrame(rows, "id long, store string, bag array<string>")
    tables = TM.term_tables(spark, str(tmp_path / "terms"), "id", ["store"])
    for k in range(3):
        TM.add_texts(tables, bags(texts[10 * k : 10 * k + 10]), "id", ["store"], f"b{k}")
        TM.add_texts(tables, bags(texts[:5]), "id", ["store"], "b0")  # again: nothing
    rounded = lambda df: sorted((r.store, r.id, r.term, r.n_texts, round(r.weight, 9), round(r.rest, 9)) for r in df.collect())
    want = rounded(S.weights(bags(texts), "id", ["store"]))
    assert rounded(TM.stored_weights(tables, "id", ["store"])) == want
    assert tables.compact() and rounded(TM.stored_weights(tables, "id", ["store"])) == want
    # A batch cut short before its entry is not counted.
    tables.write("df", spark.createDataFrame([("s", "w0", 9)], "store string, term string, n_texts long"), "cut-short")
    assert rounded(TM.stored_weights(tables, "id", ["store"])) == want


def test_weights_keep_a_text_together(spark, tmp_path, monkeypatch):
    """Terms are stored a row a text, and are sorted by text only where the order is read."""
    texts = [(i % 20 or None, "s" if i % 3 else None, [f"w{j * j % (i + 1)}" for j in range(i % 6)] + [None] * (i % 2)) for i in range(40)]
    bags = spark.createDataFrame(texts, "id long, store string, bag array<string>")
    tables = TM.term_tables(spark, str(tmp_path / "terms"), "id", ["store"])
    TM.add_texts(tables, bags.filter("id < 9"), "id", ["store"], "a")
    stored = tables.read("counts")
    assert stored.filter("id = 7 and store = 's'").select("id", F.explode("terms")).count() == len({w for i, s, b in texts if (i, s) == (7, "s") for w in b})
    once = spark.createDataFrame([(1, "s", ["a", "b", "a"]), (2, "s", [])], "id long, store string, bag array<string>")
    TM.add_texts(tables, once.withColumn("id", F.col("id") + 100), "id", ["store"], "b")
    assert [(r.id, r.terms, r.tfs) for r in tables.read("counts").filter("id > 100").collect()] == [(101, ["a", "b"], [2, 1])]

    merged = {}
    for i, store, bag in texts:
        for w in bag:
            of = merged.setdefault((store, i), {})
            of[w] = of.get(w, 0) + 1
    want = {}
    n = sum(s == "s" for _, s, _ in texts)
    for (store, i), of in merged.items():
        if store == "s":
            df = {w: sum(w in other for (t, _), other in merged.items() if t == "s") for w in of}
            raw = {w: tf * (math.log((1 + n) / (1 + df[w])) + 1) for w, tf in of.items() if w}
            length = math.sqrt(sum(x * x for x in raw.values()))
            want |= {(i, w): (df[w], round(x / length, 9)) for w, x in raw.items()}
    for common in (0, 2, 100_000):
        monkeypatch.setattr(S, "COMMON", common)
        weighted = S.weights(bags, "id", ["store"]).drop("rest")
        assert {(r.id, r.term): (r.n_texts, round(r.weight, 9)) for r in weighted.collect()} == want
        assert "Window" not in weighted._jdf.queryExecution().optimizedPlan().toString()


def test_counts_are_made_once(spark):
    """Texts whose keys are repeated, or null, are gathered before the counts are read; where
    there are none, nothing is sought in the counts."""
    schema = "id long, store string, bag array<string>"
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    rows = [(1, "s", ["a", "b"]), (1, "s", ["b", None]), (1, None, ["a"]), (2, "s", []), (2, "s", ["c"]), (3, "s", None)]
    rows += [(None, "s", ["a", "a"]), (None, "s", ["d"]), (None, "s", None)]
    counts, df, total = S.term_counts(spark.createDataFrame(rows, schema), "id", ["store"])
    assert "Aggregate" not in plan(counts)
    each = counts.select("store", "id", F.inline(F.arrays_zip("terms", "tfs")))
    assert sorted(map(tuple, each.collect()), key=str) == sorted(
        [("s", 1, "a", 1), ("s", 1, "b", 2), ("s", 1, None, 1), (None, 1, "a", 1), ("s", 2, "c", 1), ("s", None, "a", 2), ("s", None, "d", 1)], key=str
    )
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [("s", "a", 2), ("s", "b", 1), ("s", None, 1), (None, "a", 1), ("s", "c", 1), ("s", "d", 1)], key=str
    )
    assert {tuple(r) for r in total.collect()} == {("s", 8), (None, 1)}
    counts, df, _ = S.term_counts(spark.createDataFrame([(1, "s", ["a"]), (2, "s", []), (2, "t", ["a"])], schema), "id", ["store"])
    assert "Join" not in plan(counts) + plan(df) and counts.count() == 2


def test_common_terms_are_a_table_of_their_own(spark, monkeypatch):
    made, materialize = [], S.materialize
    monkeypatch.setattr(S, "materialize", lambda df: made.append(materialize(df)) or made[-1])
    texts = [(i, "s", [f"w{j}" for j in range(12) if i % (j + 1) == 0]) for i in range(40)]
    bags = spark.createDataFrame(texts, "id long, store string, bag array<string>").repartition(5)
    df = {j: sum(i % (j + 1) == 0 for i in range(40)) for j in range(12)}
    for most, common in ((0, []), (3, ["w0", "w1", "w2"]), (100_000, [f"w{j}" for j in range(12)])):
        made.clear()
        monkeypatch.setattr(S, "COMMON", most)
        found = S.weights(bags, "id", ["store"]).select("term", "n_texts").distinct().collect()
        assert {(r.term, r.n_texts) for r in found} == {(f"w{j}", n) for j, n in df.items()}
        assert [sorted(r.term for r in t.collect()) for t in made if "_idf" in t.columns] == [sorted(common)]
    # Of a step the histogram may have several pairs.
    monkeypatch.setattr(S, "COMMON", 5)
    assert S._common([{"x": 4, "y": 2.0}, {"x": 9, "y": 1.0}, {"x": 4, "y": 2.0}]) == 4
    assert S._common([{"x": 4, "y": 3.0}, {"x": 9, "y": 1.0}, {"x": 4, "y": 2.0}]) == 9
    assert S._common([{"x": 0, "y": 6.0}]) is None and S._common([]) is None


def test_tables_of_a_row_a_term_are_refused(spark, tmp_path):
    old = Tables(spark, str(tmp_path / "terms"), {"tf": "store string, id long, term string, tf long"})
    old.create()
    with pytest.raises(ValueError):
        TM.term_tables(spark, str(tmp_path / "terms"), "id", ["store"])


def word_tables(spark):
    memory = spark.createDataFrame([("fr", "x", "y")], "lang string, text_hash string, translated string")
    sentiment = spark.createDataFrame([("love", 1.0), ("hate", -1.0)], "word string, score double")
    tags = spark.createDataFrame([("i", "O"), ("love", "V"), ("hate", "V"), ("the", "D")], "word string, tag string")
    return memory, sentiment, tags


CATEGORIES = f'Store,Tier,Feature,Component,Keywords\niOS,1,Tabs,Tabs,"tab, new tab"\niOS,,General,{fixed.GENERIC_COMPONENT},"speed, fast"\n'
ISSUES = 'Store,Issue,Keywords\niOS,speed related,"slow, fast"\niOS,Bug,"open"\n'


def test_daily_job_twice(spark, tmp_path):
    memory, sentiment, tags = word_tables(spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "cat.csv").write_text(CATEGORIES)
    (tmp_path / "iss.csv").write_text(ISSUES)
    (tmp_path / "stop.txt").write_text("the\n")
    (tmp_path / "in" / "a.csv").write_text(survey_csv([
        ["2018-05-10", AGENT, "I love the tabs. They are fast", "", "USA"],
        ["2018-05-10", AGENT, "I love the tabs. They are fast", "", "USA"],
        ["2018-05-11", AGENT, "", "I hate it, it does not open. Mail me a@b.c", "USA"],
        ["2018-05-11", AGENT, "", "nothing to see", "USA"],
        ["2018-05-11", AGENT, "", "spam " * 300, "USA"],
    ]))

    before = [p for p in os.listdir(scratch_dir(spark).removeprefix("file:")) if p.startswith("murmur-")]

    def run(day):
        return pipeline.run_daily(
            spark, str(tmp_path / "in"), str(tmp_path / "cat.csv"), str(tmp_path / "iss.csv"), str(tmp_path / "stop.txt"),
            memory, sentiment, tags, str(tmp_path / "out"), datetime.date(2018, 5, day),
        )

    assert run(12) == 20180512000000
    left = [p for p in os.listdir(scratch_dir(spark).removeprefix("file:")) if p.startswith("murmur-")]
    assert sorted(left) == sorted(before)
    tables = Tables(spark, str(tmp_path / "out"))
    reviews = {r.id: r for r in tables.read("reviews").collect()}
    assert sorted(reviews) == ["20180512000000", "20180512000001", "20180512000002"]
    first, second, third = (reviews[k] for k in sorted(reviews))
    assert (first.sentiment, second.sentiment, third.sentiment) == ("Positive", "Negative", "Neutral")
    assert second.translated_reviews == "I hate it, it does not open. Mail me "
    assert first.clear_filters == "Clear Filters" and first.spam == 0
    categories = sorted((r.id[-1], r.component) for r in tables.read("categorization").collect())
    assert categories == [("0", "Tabs"), ("1", "Others"), ("2", "Others")]
    issues = sorted((r.id[-1], r.key_issue) for r in tables.read("key_issue").collect())
    assert issues == [("0", "speed related"), ("1", "Bug")]
    # The same files again: nothing is newer than the mark.
    run(12)
    assert tables.read("reviews").count() == 3
    (tmp_path / "in" / "b.csv").write_text(survey_csv([["2018-05-12", AGENT, "I love the tabs a lot", "", ""]]))
    assert run(12) == 20180512000003
    assert tables.read("reviews").count() == 4 and tables.read("categorization").count() == 4
    whole = RP.report(tables.read_with_numbers("reviews"), tables.read_with_numbers("categorization"),
                      tables.read_with_numbers("key_issue"), issue="key_issue")
    assert [(r.n_components, r.issues) for r in whole.collect()][:2] == [(1, ["speed related"]), (1, ["Bug"])]


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    memory, sentiment, tags = word_tables(spark)
    schema = "line long, store string, device string, source string, country string, date date, version double, rating string, lang string, original string"
    day = datetime.date(2018, 5, 10)
    rows = [(i, "iOS", "iPhone", "s", "", day + datetime.timedelta(i // 3), 1.0, "", "en", t) for i, t in enumerate(
        ["I love the tabs", "call 555-1234 now", "I love the tabs", "so fast", "x " * 600])]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    assert clean_stream(stream).isStreaming
    lexicons = pipeline.Lexicons(
        components=spark.createDataFrame([("iOS", "tab", "Tabs", "F")], "store string, keyword string, component string, feature string"),
        issues=spark.createDataFrame([("iOS", "fast", "speed")], "store string, keyword string, issue string"),
        memory=memory, sentiment=sentiment, tags=tags,
    )
    tables = Tables(spark, str(tmp_path / "out"))
    query = load_stream(stream, lexicons, tables, str(tmp_path / "ck"), "line", lambda: datetime.date(2018, 6, 1))
    query.awaitTermination(300)
    assert query.exception() is None
    assert sorted(r.translated_reviews for r in tables.read("reviews").collect()) == ["I love the tabs", "call  now", "so fast"]
    assert sorted(r.component for r in tables.read("categorization").collect()) == ["Others", "Others", "Tabs"]


def test_stream_of_several_files_of_a_day(spark, tmp_path):
    """Three files of one day, one with a late row, a file to a batch: as one batch load."""
    memory, sentiment, tags = word_tables(spark)
    schema = "line long, store string, device string, source string, country string, date date, version double, rating string, lang string, original string"
    day = datetime.date(2018, 5, 10)
    files = [[(0, "I love the tabs", 0), (1, "so fast", 0)], [(2, "slow today", 0), (3, "late words", -3)], [(4, "tabs again", 0)]]
    for n, own in enumerate(files):
        rows = [(i, "iOS", "iPhone", "s", "", day + datetime.timedelta(late), 1.0, "", "en", t) for i, t, late in own]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{n}"))
    lexicons = pipeline.Lexicons(
        components=spark.createDataFrame([("iOS", "tab", "Tabs", "F")], "store string, keyword string, component string, feature string"),
        issues=spark.createDataFrame([("iOS", "fast", "speed")], "store string, keyword string, issue string"),
        memory=memory, sentiment=sentiment, tags=tags,
    )
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    tables = Tables(spark, str(tmp_path / "out"))
    for _ in range(2):  # the second run finds nothing new
        query = load_stream(stream, lexicons, tables, str(tmp_path / "ck"), "line", lambda: datetime.date(2018, 6, 1))
        query.awaitTermination(300)
        assert query.exception() is None
    batch = Tables(spark, str(tmp_path / "batch"))
    whole, categories, issues = pipeline.tag(pipeline.preprocess(spark.read.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in")), memory, sentiment, "line"), lexicons)
    I.load(batch, whole, categories, issues, datetime.date(2018, 6, 1))

    def content(t):
        reviews = t.read("reviews")
        texts = reviews.select("id", "translated_reviews")
        joined = texts.join(t.read("categorization"), "id").select("translated_reviews", "component").collect()
        return sorted(r.translated_reviews for r in texts.collect()), sorted(map(tuple, joined)), reviews.select("id").distinct().count()

    assert content(tables) == content(batch)
    assert content(tables)[2] == 5


def test_a_stream_of_shared_texts_brings_each_once(spark, tmp_path):
    """Three files of one day that share texts, a file to a micro-batch; then a batch load."""
    memory, sentiment, tags = word_tables(spark)
    schema = "line long, store string, device string, source string, country string, date date, version double, rating string, lang string, original string"
    for n, own in enumerate([["I love the tabs", "so fast"], ["so fast", "slow today"], ["slow today", "I love the tabs", "tabs again"]]):
        rows = [(10 * n + i, "iOS", "iPhone", "s", "", datetime.date(2018, 5, 10), 1.0, "", "en", t) for i, t in enumerate(own)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{n}"))
    lexicons = pipeline.Lexicons(
        components=spark.createDataFrame([("iOS", "tab", "Tabs", "F")], "store string, keyword string, component string, feature string"),
        issues=spark.createDataFrame([("iOS", "fast", "speed")], "store string, keyword string, issue string"),
        memory=memory, sentiment=sentiment, tags=tags,
    )
    read = lambda **o: spark.readStream.schema(schema).options(recursiveFileLookup=True, **o).parquet(str(tmp_path / "in"))
    tables = Tables(spark, str(tmp_path / "out"))
    query = load_stream(read(maxFilesPerTrigger=1), lexicons, tables, str(tmp_path / "ck"), "line", lambda: datetime.date(2018, 6, 1), once=True)
    query.awaitTermination(300)
    assert query.exception() is None
    texts = lambda: sorted(r.translated_reviews for r in tables.read("reviews").collect())
    want = ["I love the tabs", "slow today", "so fast", "tabs again"]
    assert texts() == want
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    whole, categories, issues = pipeline.tag(pipeline.preprocess(rows, memory, sentiment, "line"), lexicons)
    I.load(tables, whole, categories, issues, datetime.date(2018, 6, 1), since=datetime.date(2000, 1, 1), once=True)
    assert texts() == want
