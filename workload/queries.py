"""The registered queries: each runs an operator over whole test tables."""

from __future__ import annotations

import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from murmur import fixed
from murmur.functions import agent, cleaning, text as T, values as V
from murmur.operators import clusters as C, enrich as E, expand as X, joins as J, matching as M
from murmur.operators import phrases as P, rows as R, similarity as S, stats as ST, tagging as G
from murmur.plans import incremental as I, pipeline, report as RP, terms as TM
from murmur.session import materialize, materialize_alone, scratch_path, spread, tune
from murmur.sources import dictionaries as D, feedback as FB, tables as TB
from workload import fixtures as X_


IOS, WEB = fixed.VERSION_MARKERS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark, folder, *columns) -> DataFrame:
    df = table(spark, folder, "documents")
    return spread(df.select(*columns) if columns else df)


def as_feedback(spark, folder) -> DataFrame:
    """Documents in the feedback schema: language as store, source as device."""
    return documents(spark, folder, "doc_id", "lang", "source", "text").select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("store"),
        F.col("source").alias("device"),
        F.col("text").alias("translated"),
    )


def _local(spark, rows, schema: str) -> DataFrame:
    """A constant table; through Arrow its size is known to the optimizer."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    columns = {n: [r[i] for r in rows] for i, n in enumerate(names)}
    return spark.createDataFrame(pa.table(columns)).select(
        *[F.col(n).cast(c.strip().split(" ")[1]).alias(n) for n, c in zip(names, schema.split(","))]
    )


def categories(spark) -> DataFrame:
    rows = [(*r, i) for i, r in enumerate(X_.CATEGORIES)]
    return _local(
        spark, rows, "store string, tier string, feature string, component string, keywords string, line long"
    )


def issues(spark) -> DataFrame:
    return _local(spark, X_.ISSUES, "store string, issue string, keywords string")


def tags(spark) -> DataFrame:
    return _local(spark, X_.TAGS, "word string, tag string")


def lexicon(spark) -> DataFrame:
    return _local(spark, X_.SENTIMENT, "word string, score double")


def senses(spark, folder) -> DataFrame:
    """A sense table from part names: a name has one sense per type, the first by type."""
    return table(spark, folder, "part").select(
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("lemma"),
        F.concat_ws(":", F.substring_index("p_name", " ", 1), "p_type").alias("synset_id"),
        F.col("p_type").alias("rank"),
    ).distinct()


# --- cleaning ---------------------------------------------------------------------


def pii_detect(spark, folder):
    t = F.col("text")
    return documents(spark, folder, "doc_id", "text").select(
        "doc_id",
        cleaning.has_email(t).cast("int").alias("has_email"),
        cleaning.has_phone(t).cast("int").alias("has_phone"),
        cleaning.has_personal_data(t).cast("int").alias("has_pii"),
    )


def pii_scrub(spark, folder):
    return documents(spark, folder, "doc_id", "text").select(
        "doc_id", cleaning.scrub(F.col("text")).alias("text")
    )


def spam_flags(spark, folder):
    t = F.col("text")
    return documents(spark, folder, "doc_id", "text").select(
        "doc_id",
        cleaning.too_long(t).cast("int").alias("too_long"),
        cleaning.too_many_numbers(t).cast("int").alias("too_many_numbers"),
        cleaning.no_language(t).cast("int").alias("no_language"),
        cleaning.screen(t)["spam"].cast("int").alias("spam"),
    )


def spam_two_passes(spark, folder):
    """Original texts first, then their translations (here: upper case)."""
    first = R.spam_filter(documents(spark, folder, "doc_id", "text"), "text")
    second = R.spam_filter(first.withColumn("translated", F.concat(F.replace("text", F.lit("a"), F.lit("A")), F.lit(" 555-1234"))))
    return second.select("doc_id", "text", "translated", "spam")


def dedup_exact(spark, folder):
    return R.first_copies(documents(spark, folder, "doc_id", "text", "lang", "source"), "text", "doc_id")


def clean_pipeline(spark, folder):
    clean = R.spam_filter(documents(spark, folder, "doc_id", "text", "lang"), "text")
    return R.first_copies(materialize(clean), "text", "doc_id")


# --- sources ----------------------------------------------------------------------

_AGENT = (
    "concat('Agent/5.0 (', element_at(array('iPhone','iPad','Windows','Macintosh','Linux','Other'),"
    " cast(user_id % 6 as int) + 1), case when event_id % 5 = 0 then '; Linux' else '' end, ') ',"
    f" element_at(array('{IOS}','{WEB}','Other/','{WEB}x','{IOS}'), cast(event_id % 5 as int) + 1),"
    " cast(event_id % 90 as string), '.', cast(user_id % 12 as string),"
    " case when event_id % 3 = 0 then '.7b12' else '' end, ' Tail/1.0',"
    f" case when event_id % 7 = 0 then ' {WEB}88.1' else '' end)"
)


def _agents(spark, folder):
    return table(spark, folder, "events").select("event_id", F.expr(_AGENT).alias("agent"))


def device_store(spark, folder):
    device = agent.device(F.col("agent"))
    return _agents(spark, folder).select(
        "event_id", device.alias("device"), agent.store_of(device).alias("store")
    )


def version_extract(spark, folder):
    return _agents(spark, folder).select("event_id", agent.version(F.col("agent")).alias("version"))


def country_recode(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    names = {"UNITED STATES": "United States", "NATION_3": "United States"}
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", V.recode(F.col("n_name"), names).alias("country")
    )


def _survey(spark, folder):
    """Documents in the layout of the survey export."""
    mapping = fixed.SOURCE_COLUMNS[fixed.SURVEY]
    like, problem = mapping["original"]
    return documents(spark, folder).select(
        F.expr("date_format(date_add(date '2024-01-01', cast(doc_id % 30 as int)), 'yyyy-MM-dd')").alias(
            mapping["date"]
        ),
        F.expr(
            "concat('Agent/5.0 (', element_at(array('iPhone','iPad','Linux'), cast(doc_id % 3 as int) + 1),"
            f" ') {WEB}', cast(doc_id % 60 as string), '.', cast(doc_id % 7 as string))"
        ).alias(mapping["device"]),
        F.when(F.col("source") == "src0", F.lit(None)).otherwise(F.col("source")).alias(like),
        F.col("text").alias(problem),
        F.when(F.col("lang") == "en", "USA").otherwise(F.col("lang")).alias(mapping["country"]),
    )


def _store_reviews(spark, folder):
    """Conversations in the layout of the store review export."""
    return table(spark, folder, "conversations").select(
        F.lit("2024-02-03").alias("Date"),
        F.concat(F.col("turn").cast("string"), F.lit(".5")).alias("Version"),
        F.col("role").alias("Store"),
        (F.col("turn") % 5 + 1).cast("string").alias("Rating"),
        F.col("role").alias("Subject"),
        F.col("text").alias("Body"),
        F.lit("USA").alias("Country"),
    )


def _normalized(df):
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def normalize_union(spark, folder):
    return _normalized(
        FB.union([FB.normalize(_survey(spark, folder)), FB.normalize(_store_reviews(spark, folder))])
    )


def read_feedback_files(spark, folder):
    """The same two exports, written as CSV files and read as a folder: both layouts in one
    sub-folder, one of them with its columns in another order in some files."""
    root = scratch_path(spark, "input")
    survey, reviews = _survey(spark, folder), _store_reviews(spark, folder)
    names = [f"`{c}`" for c in survey.columns]
    odd = F.pmod(F.xxhash64(*names), F.lit(2)) == 1
    turned = survey.filter(odd).select(*reversed(names))
    for df in (survey.filter(~odd), turned, reviews):
        writer = df.write.mode("append").option("header", True).option("quoteAll", True).option("escape", '"')
        writer.csv(f"{root}/mixed")
    return _normalized(FB.read_feedback(spark, root).drop("line"))


def source_kind(spark, folder):
    """The source each table's columns are taken for, with its rows."""
    frames = {"documents": _survey(spark, folder), "conversations": _store_reviews(spark, folder),
              "events": table(spark, folder, "events")}
    rows = [
        df.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("name"), F.lit(FB.identify_source(df.columns)).alias("source"), "n"
        )
        for name, df in frames.items()
    ]
    return FB.union(rows)


def keyword_split(spark, folder):
    listed = F.concat("p_name", F.lit(", "), "p_type", F.lit(",,  "), "p_brand", F.lit(" ,"))
    return table(spark, folder, "part").select(
        "p_partkey", F.posexplode(V.split_list(listed)).alias("pos", "word")
    )


def _part_categories(spark, folder):
    """A dictionary written from part names, one file line per name and brand."""
    return table(spark, folder, "part").groupBy(
        F.col("p_type").alias("store"), F.col("p_brand").alias("component")
    ).agg(
        F.lit("1").alias("tier"),
        F.min("p_name").alias("feature"),
        F.array_join(F.array_sort(F.collect_set("p_name")), ", ").alias("keywords"),
    )


def dictionary_scan(spark, folder):
    """A category dictionary file: read, split into keywords."""
    path = scratch_path(spark, "dictionary")
    rows = _part_categories(spark, folder).select("store", "tier", "feature", "component", "keywords")
    rows.write.option("header", True).option("quoteAll", True).csv(path)
    return D.listed_keywords(D.read_categories(spark, path), "store", "feature", "component")


def issue_dictionary_scan(spark, folder):
    path = scratch_path(spark, "issues")
    rows = _part_categories(spark, folder).select("store", F.col("component").alias("issue"), "keywords")
    rows.write.option("header", True).option("quoteAll", True).csv(path)
    return D.listed_keywords(D.read_issues(spark, path), "store", "issue")


def word_list(spark, folder):
    """A word list file with extras, in normal form."""
    path = scratch_path(spark, "words")
    D.write_words(table(spark, folder, "part").select("p_name"), path)
    return D.read_words(spark, path, extra=["Plates", "please"])


def unique_words(spark, folder):
    """Distinct part names in the order of their first appearance."""
    names = D.unique_words(table(spark, folder, "part"), "p_name", "p_partkey")
    return names.select(F.col("p_name").alias("word"))


# --- persisted tables ---------------------------------------------------------------


def _sink_feedback(spark, folder):
    return documents(spark, folder).select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("store"),
        F.lit("Unknown").alias("device"),
        "source",
        F.lit("").alias("country"),
        F.expr("date_add(date '2024-01-01', cast(doc_id % 30 as int))").alias("date"),
        F.lit(1.5).alias("version"),
        F.lit("").alias("rating"),
        F.col("text").alias("original"),
        F.when(F.col("lang") == "es", F.lit(None)).otherwise(F.concat("text", F.lit("|"), "text")).alias("translated"),
        F.lit("Neutral").alias("sentiment"),
        F.lit(0).alias("spam"),
        F.array("lang", "source").alias("verb_phrases"),
        F.array("source").alias("noun_phrases"),
    )


def sink_rows(spark, folder):
    base = int(X_.TODAY.replace("-", "") + "000000")
    rows = TB.review_rows(_sink_feedback(spark, folder), base)
    return rows.withColumn("us_date", V.date_text(F.col("review_date"), american=True)).withColumn(
        "review_date", V.date_text(F.col("review_date"))
    )


def persisted_roundtrip(spark, folder):
    """Create, append twice (once an empty batch), clear one table, read back."""
    tables = TB.Tables(spark, scratch_path(spark, "tables"))
    tables.create()
    rows = TB.review_rows(_sink_feedback(spark, folder), 0)
    tables.append("reviews", rows)
    tables.append("reviews", rows.filter(F.lit(False)))
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("string").alias("issue"))
    tables.append("key_issue", TB.issue_rows(labels, 0))
    tables.append("categorization", TB.category_rows(labels.select(
        "id", F.lit("f").alias("feature"), F.lit("c").alias("component"), F.array("issue").alias("actions")), 0))
    tables.clear("categorization")
    reviews = tables.read_with_numbers("reviews").select("id", "store", F.length("translated_reviews").alias("chars"))
    return (
        reviews.join(tables.read_with_numbers("key_issue"), "id", "left")
        .join(tables.read_with_numbers("categorization").select("id", "feature"), "id", "left")
        .select("id", "store", "chars", "key_issue", "feature")
    )


def incremental_load(spark, folder):
    """Loads of the same feedback on one day, some of it without a date; the first is
    repeated under its name. The second adds nothing old."""
    tables = TB.Tables(spark, scratch_path(spark, "tables"))
    undated = F.col("id") % 7 == 3
    feedback = _sink_feedback(spark, folder).withColumn("date", F.when(~undated, F.col("date")))
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("string").alias("issue"))
    none = labels.select("id", F.lit("f").alias("feature"), F.lit("c").alias("component"), F.array("issue").alias("actions"))
    day = datetime.date.fromisoformat(X_.TODAY)
    early = feedback.filter(F.col("id") % 30 < 14)
    for rows, batch in ((early, "first"), (early, "first"), (feedback, "second")):
        I.load(tables, rows, none, labels, day, batch)
    counts = [
        tables.read(n).agg(F.count("*").alias("rows"), F.min("id").alias("low"), F.max("id").alias("high")).select(
            F.lit(n).alias("name"), "rows", "low", "high")
        for n in ("reviews", "categorization", "key_issue", "undated")
    ]
    return FB.union(counts)


def _counted(frames):
    return FB.union([
        rows.agg(F.count("*").alias("rows"), F.min("id").alias("low"), F.max("id").alias("high")).select(F.lit(n).alias("name"), "rows", "low", "high")
        for n, rows in frames.items()
    ])


def load_snapshot(spark, folder):
    """A load, one that was cut short before its entry, a table cleared, parts merged, and
    one more load: the tables as SQL sees them."""
    tables = TB.Tables(spark, scratch_path(spark, "tables"))
    feedback = _sink_feedback(spark, folder)
    none = feedback.select("id", F.lit("f").alias("feature"), F.lit("c").alias("component"), F.array("source").alias("actions"))
    issues = feedback.select("id", F.col("source").alias("issue"))
    day = datetime.date.fromisoformat(X_.TODAY)
    I.load(tables, feedback.filter(F.col("id") % 30 < 10), none, issues, day, "first")
    tables.write("reviews", TB.review_rows(feedback, 0), "cut-short")
    tables.clear("key_issue")
    tables.compact()
    I.load(tables, feedback, none, issues, day, "second")
    return _counted({n: spark.sql(tables.select(n)) for n in ("reviews", "categorization", "key_issue")})


def load_once(spark, folder):
    """Three loads of one day that share texts: each text comes once, with its first load."""
    tables = TB.Tables(spark, scratch_path(spark, "tables"))
    feedback = _sink_feedback(spark, folder)
    none = feedback.select("id", F.lit("f").alias("feature"), F.lit("c").alias("component"), F.array("source").alias("actions"))
    issues = feedback.select("id", F.col("source").alias("issue"))
    day, first = datetime.date.fromisoformat(X_.TODAY), datetime.date(2000, 1, 1)
    for k in range(3):
        part = R.first_copies(feedback.filter(F.col("id") % 3 == k), "original", "id")
        I.load(tables, part, none, issues, day, f"load{k}", first, once=True)
    loads = tables.log().filter("first_id IS NOT NULL").select("batch", "first_id", "top")
    of = tables.read_with_numbers("reviews").join(loads, F.col("id").between(F.col("first_id"), F.col("top")))
    return of.groupBy("batch").agg(F.count("*").alias("rows"), F.sum(F.col("id") - F.col("first_id")).alias("places"))


def compacted_lookup(spark, folder):
    """Labels in 12 loads, merged into files of 200 rows: rows of three IDs, and in how many
    files the index looks for each."""
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("string").alias("issue"))
    tables = TB.Tables(spark, scratch_path(spark, "tables"))
    tables.create()
    for k in range(12):
        tables.append("key_issue", TB.issue_rows(labels.filter(F.col("id") % 12 == k), 0))
    tables.compact(rows_a_file=200)
    ends = RP.id_range(labels).first()
    asked = [str(ends["min_id"]), str(ends["max_id"]), str(ends["max_id"] + 1)]
    return FB.union([
        tables.find("key_issue", i).groupBy().agg(F.count("*").alias("rows"), F.max("key_issue").alias("key_issue")).select(
            F.lit(i).alias("id"), F.lit(len(tables.files_with("key_issue", i))).alias("files"), "rows", "key_issue")
        for i in asked
    ])


def translation_memory(spark, folder):
    return E.translate(
        documents(spark, folder, "doc_id", "lang", "text"), _memory(spark, folder), "text"
    ).select("doc_id", "lang", "translated")


def _memory(spark, folder):
    """Translations of the labelled documents."""
    labelled = table(spark, folder, "labels").select("doc_id")
    return documents(spark, folder, "doc_id", "lang", "text").join(labelled, "doc_id").select(
        "lang", E.text_key(F.col("text")).alias("text_hash"),
        F.concat(F.lit("it&#39;s "), F.replace("text", F.lit("a"), F.lit("A"))).alias("translated"),
    )


def html_unescape(spark, folder):
    raw = F.replace("text", F.lit("e "), F.lit("e&#39;"))
    return documents(spark, folder, "doc_id", "text").select("doc_id", V.unescape(raw).alias("text"))


def sentiment_label(spark, folder):
    scores = E.sentiment_scores(documents(spark, folder, "doc_id", "text"), lexicon(spark), "text", "doc_id")
    return scores.select(
        "doc_id",
        F.round("score", 6).alias("score"),
        F.round("magnitude", 6).alias("magnitude"),
        V.sentiment_label(F.col("score"), F.col("magnitude")).alias("sentiment"),
    )


def dense_ids(spark, folder):
    folded = R.first_copies(documents(spark, folder, "doc_id", "text"), "text", "doc_id")
    return R.dense_ids(folded.select("doc_id"), "doc_id")


def batch_id_base(spark, folder):
    start = int(X_.TODAY.replace("-", "") + "000000")
    of = lambda name, key: table(spark, folder, name).select((F.col(key) + start).cast("string").alias("id"))
    top = I.max_id([of("orders", "o_orderkey"), of("lineitem", "l_orderkey"), of("events", "event_id")])
    return top.select(
        "max_id",
        I.batch_base(F.col("max_id"), F.lit(datetime.date.fromisoformat(X_.TODAY))).alias("same_day"),
        I.batch_base(F.col("max_id"), F.lit(datetime.date(2024, 1, 16))).alias("next_day"),
        # After a day with more than a million rows the next one starts behind it.
        I.batch_base(F.col("max_id") + 4_500_000, F.lit(datetime.date(2024, 1, 16))).alias("after_large_day"),
    )


def high_water_mark(spark, folder):
    events = table(spark, folder, "events").select("ts", "event_type")
    by_type = events.groupBy("event_type").agg(F.max("ts").alias("ts"))
    whole = I.high_water_mark(events, "ts").select(F.lit("all").alias("part"), "max_date")
    none = I.high_water_mark(events.filter(F.col("event_type").isNull()), "ts").select(F.lit("none").alias("part"), "max_date")
    tops = by_type.select(F.col("event_type").alias("part"), F.col("ts").cast("date").alias("max_date"))
    return whole.union(none).union(tops).select("part", F.date_format("max_date", "yyyy-MM-dd").alias("max_date"))


def incremental_filter(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("date"))
    items = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_quantity")
    mark = F.lit(datetime.date.fromisoformat(X_.HIGH_WATER))
    new, (kept,) = I.newer_than(orders, [items], mark)
    sums = kept.groupBy("id").agg(F.count("*").alias("n_items"), F.sum("l_quantity").alias("quantity"))
    return new.join(sums, "id", "full").select(
        "id", F.date_format("date", "yyyy-MM-dd").alias("date"), "n_items", F.round("quantity", 2).alias("quantity")
    )


def forward_fill(spark, folder):
    """A listing that names the flag on an order's second line only; its third is empty."""
    lines = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("line"),
        F.when(F.col("l_linenumber") == 2, F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_linenumber") != 3, F.col("l_linestatus")).alias("status"),
    )
    unique = lines.groupBy("line").agg(F.max("flag").alias("flag"), F.max("status").alias("status"))
    return R.fill_listing(unique, "line", "flag", block=100_000).select("line", "flag")


def stage_counts(spark, folder):
    """Rows read, cleaned and distinct, counted while the stages run."""
    stages = [("cleaned", lambda df: R.spam_filter(df, "text")), ("distinct", lambda df: R.first_copies(df, "text", "doc_id"))]
    return R.observed_counts(documents(spark, folder, "doc_id", "text"), stages)[1]


def distinct_labels(spark, folder):
    return table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus").distinct()


# --- statistics -----------------------------------------------------------------------


def tokenize_count(spark, folder):
    words = T.words(F.col("text"))
    return documents(spark, folder, "doc_id", "text").select(
        "doc_id", F.size(words).alias("n_words"), F.size(F.array_distinct(words)).alias("n_distinct")
    )


def normalize_text(spark, folder):
    return documents(spark, folder, "doc_id", "text").select(
        "doc_id", F.array_join(T.terms(F.col("text"), X_.STOP), " ").alias("normal")
    )


def term_freq(spark, folder):
    return ST.term_counts(documents(spark, folder, "text"), "text", X_.STOP)


def word_freq(spark, folder):
    counts = ST.term_counts(documents(spark, folder, "text"), "text", X_.STOP, normal=False)
    return ST.by_count(counts)


def clean_term_freq(spark, folder):
    rows = documents(spark, folder, "text").select(F.explode(T.words(F.col("text"))).alias("w"))
    counts = rows.groupBy(F.lower("w").alias("term")).agg(F.count("*").alias("n"))
    return ST.clean_terms(counts, X_.STOP)


def top_terms(spark, folder):
    return ST.top_terms(ST.term_counts(documents(spark, folder, "text"), "text", X_.STOP), 100, 50)


def group_top_terms(spark, folder):
    counts = ST.term_counts(documents(spark, folder, "lang", "text"), "text", X_.STOP, by=["lang"])
    return ST.top_terms(counts, 0, 20, ["lang"])


def review_top_terms(spark, folder):
    return ST.terms_of_each(documents(spark, folder, "doc_id", "text"), "text", "doc_id", X_.STOP).select(
        "doc_id", F.array_join("keywords", " ").alias("keywords")
    )


def list_freq(spark, folder):
    listed = F.concat_ws(", ", F.replace("p_name", F.lit(" "), F.lit(", ")), "p_type", "p_brand")
    return ST.list_counts(table(spark, folder, "part").select(listed.alias("items")), "items")


def surface_mode(spark, folder):
    return ST.usual_words(documents(spark, folder, "text"), "text")


# --- dictionaries -----------------------------------------------------------------------


def pair_expand(spark, folder):
    phrase = F.concat_ws(" ", "p_name", "p_type")
    return X.word_pairs(table(spark, folder, "part").select(phrase.alias("phrase")).distinct(), "phrase", ["phrase"])


def negation_expand(spark, folder):
    verbs = table(spark, folder, "part").select(
        F.col("p_type").alias("store"), F.substring_index("p_name", " ", -1).alias("verb")
    ).distinct()
    return X.negations(verbs, "verb", ["store"])


def synonym_expand(spark, folder):
    words = table(spark, folder, "part").select(F.replace("p_name", F.lit(" "), F.lit("_")).alias("word"))
    return X.synonyms(words, senses(spark, folder))


def word_similarity(spark, folder):
    names = table(spark, folder, "part").select(
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("a"),
        F.concat_ws("_", F.substring_index("p_name", " ", 1), F.lit("gear")).alias("b"),
    ).distinct()
    return X.same_sense(names, senses(spark, folder), "a", "b")


def component_keywords(spark, folder):
    dictionary = _part_categories(spark, folder).withColumn("line", F.xxhash64("store", "component"))
    return X.component_keywords(dictionary, senses(spark, folder)).select(
        "store", "keyword", "component", "feature", "tier"
    )


# --- matching and tagging ---------------------------------------------------------------


def _plain_keywords(spark):
    return D.listed_keywords(categories(spark), "store").distinct()


def proximity_match(spark, folder):
    phrases = _plain_keywords(spark).filter(F.col("keyword").rlike("[ -]"))
    return M.find_words(as_feedback(spark, folder), M.keyword_pairs(phrases), "translated", ["id"], X_.STOP)


def find_words(spark, folder):
    pairs = M.keyword_pairs(_plain_keywords(spark))
    return M.find_words(as_feedback(spark, folder), pairs, "translated", ["id"], X_.STOP)


def find_in_parts(spark, folder):
    """Words and phrases of a colour and fastener dictionary in part names."""
    keyword = F.explode(F.array(*[F.lit(k) for k in X_.PART_KEYWORDS])).alias("keyword")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("store"), "p_name")
    pairs = M.keyword_pairs(parts.select("store").distinct().select("store", keyword))
    return M.find_words(parts, pairs, "p_name", ["id"], X_.STOP)


def fallback_issue(spark, folder):
    """Part names with their words turned round, looked up among the names of all brands."""
    part = table(spark, folder, "part")
    turned = F.array_join(F.reverse(F.split("p_name", " ")), " ")
    unlisted = part.select(F.col("p_type").alias("store"), turned.alias("keyword")).distinct()
    listed = part.select(
        F.col("p_type").alias("store"), F.col("p_name").alias("keyword"), F.col("p_size").cast("string").alias("issue")
    )
    return M.unlisted_issue(unlisted, listed)


def sentence_split(spark, folder):
    return (
        documents(spark, folder, "doc_id", "text")
        .select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("pos", "sentence"))
        .filter(F.col("sentence") != "")
    )


def sentence_windows(spark, folder):
    conv = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    kept = F.filter(T.sentences(F.col("text")), lambda s: s != "")
    return conv.select("conv_id", "turn", F.posexplode(T.windows(kept)).alias("pos", "run")).select(
        "conv_id", "turn", "pos", F.array_join("run", " / ").alias("run")
    )


def keyword_context(spark, folder):
    words = J.settled(D.listed_keywords(categories(spark), "store").distinct()).withColumn(
        "term", T.normal_form(F.col("keyword"))
    )
    targets = words.groupBy("store").agg(F.collect_set("term").alias("targets"))
    docs = as_feedback(spark, folder).join(targets, "store")
    hits = docs.select("id", "store", F.posexplode(T.contexts(F.col("translated"), F.col("targets"))).alias("pos", "hit"))
    return hits.select("id", "store", "pos", "hit.term", "hit.context").join(
        words, ["store", "term"]
    ).select("id", "keyword", "pos", "context")


def _phrased(spark, folder):
    return materialize(P.add_phrases(as_feedback(spark, folder), "translated", "id", tags(spark), default="N"))


def phrase_chunks(spark, folder):
    return _phrased(spark, folder).select(
        "id",
        F.array_join("verb_phrases", ", ").alias("verb_phrases"),
        F.array_join("noun_phrases", ", ").alias("noun_phrases"),
    )


def phrase_text(spark, folder):
    return P.phrase_text(_phrased(spark, folder), "id")


def categorize(spark, folder):
    found = G.categorize(
        _phrased(spark, folder), X.component_keywords(categories(spark)), X_.STOP, generic=X_.GENERIC
    )
    return found.withColumn("actions", F.array_join("actions", " || "))


def generic_component_drop(spark, folder):
    flags = table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag").distinct()
    return G.drop_generic(flags, "l_orderkey", "l_returnflag", "N")


def key_issues(spark, folder):
    return G.key_issues(as_feedback(spark, folder), X.issue_keywords(issues(spark)), X_.STOP)


# --- similarity ---------------------------------------------------------------------------


def _one_device(spark, folder):
    """The documents as feedback of one device: a group per language."""
    return as_feedback(spark, folder).withColumn("device", F.lit("any"))


def _bags(spark, folder):
    return S.bags(_one_device(spark, folder), "translated", "id", ["store", "device"], X_.STOP)


def tfidf(spark, folder):
    bags = S.bags(documents(spark, folder, "lang", "doc_id", "text"), "text", "doc_id", ["lang"], normal=False)
    return S.weights(bags, "doc_id", ["lang"]).select(
        "lang", "doc_id", "term", "n_texts", F.round("weight", 6).alias("weight")
    )


def tfidf_over_loads(spark, folder):
    """``tfidf`` after three loads, one of them repeated, and a compaction."""
    by, key = ["lang"], "doc_id"
    bags = S.bags(documents(spark, folder, "lang", "doc_id", "text"), "text", key, by, normal=False)
    tables = TM.term_tables(spark, scratch_path(spark, "terms"), key, by)
    for k, batch in ((0, "a"), (1, "b"), (1, "b"), (2, "c")):
        TM.add_texts(tables, bags.filter(F.col(key) % 3 == k), key, by, batch)
        if k == 1:
            tables.compact()
    return TM.stored_weights(tables, key, by).select("lang", "doc_id", "term", "n_texts", F.round("weight", 6).alias("weight"))


def cosine_pairs(spark, folder):
    kept, _ = S.fold_copies(_bags(spark, folder), "id", ["store", "device"])
    by = ["store", "device"]
    weighted = S.weights(kept, "id", by, "copies")
    pairs = S.similar_pairs(weighted, "id", by, fixed.CLUSTER_SIMILARITY)
    return pairs.withColumn("similarity", F.round("similarity", 6))


def clusters(spark, folder):
    return C.cluster_texts(_bags(spark, folder), "id", ["store", "device"])


def _clustered(spark, folder):
    found = materialize_alone(lambda: clusters(spark, folder)).select("id", "cluster")
    return _one_device(spark, folder).join(found, "id")


def cluster_summary(spark, folder):
    return S.summaries(_clustered(spark, folder), "translated", "id", ["cluster"])


def group_summary(spark, folder):
    """The summary of each language's texts."""
    return S.summaries(as_feedback(spark, folder), "translated", "id", ["store"])


def cluster_keywords(spark, folder):
    return C.cluster_keywords(_clustered(spark, folder), "translated", ["store", "cluster"], X_.STOP, k=3)


def merged_words(spark, folder):
    bags = C.merge_similar_words(
        as_feedback(spark, folder), "translated", "id", ["store", "device"], _document_senses(spark, folder), X_.STOP
    )
    return bags.select("id", F.array_join("bag", " ").alias("bag"))


def _document_senses(spark, folder):
    """Words of the documents, with their letters in order as their sense."""
    words = documents(spark, folder, "text").select(F.explode(T.words(F.col("text"))).alias("w"))
    letters = F.array_join(F.sort_array(F.split("lemma", "")), "")
    # Written once: the optimizer would leave distinct() out before a minimum, and sort the
    # letters of every use of a word.
    return materialize(words.select(F.lower("w").alias("lemma")).distinct()).select(
        "lemma", letters.alias("synset_id"), F.lit(1).alias("rank")
    )


def bottom_up_issues(spark, folder):
    listed = D.listed_keywords(categories(spark), "store").distinct()
    phrased = _phrased(spark, folder).withColumn("device", F.lit("any"))
    return C.bottom_up_issues(phrased, _document_senses(spark, folder), listed, X_.STOP)


# --- whole plans ----------------------------------------------------------------------------


def _preprocessed(spark, folder):
    rows = documents(spark, folder, "doc_id", "lang", "source", "text").withColumnRenamed("text", "original")
    return pipeline.preprocess(rows, _memory(spark, folder), lexicon(spark), "doc_id")


def preprocess(spark, folder):
    return _preprocessed(spark, folder).select(
        "id", "doc_id", "original", "translated", "sentiment", "spam"
    )


def report(spark, folder):
    fb = as_feedback(spark, folder).select("id", "store", "device")
    found = G.categorize(_phrased(spark, folder), X.component_keywords(categories(spark)), X_.STOP, generic=X_.GENERIC)
    result = RP.report(fb, found, key_issues(spark, folder))
    return result.withColumns({c: F.array_join(c, ", ") for c in ("components", "issues")})


def order_report(spark, folder):
    """Orders with the flags and modes of their items."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    items = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"), "l_returnflag", "l_linestatus")
    result = RP.report(orders, items, items, component="l_returnflag", issue="l_linestatus")
    return result.withColumns({c: F.array_join(c, ", ") for c in ("components", "issues")})


def id_lookup(spark, folder):
    """A point lookup in a persisted table: the issues of the last labelled feedback."""
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("string").alias("issue"))
    tables = TB.Tables(spark, scratch_path(spark, "tables"))
    tables.create()
    tables.append("key_issue", TB.issue_rows(labels, 0))
    return tables.find("key_issue", str(RP.id_range(labels).first()["max_id"]))


def id_range(spark, folder):
    return RP.id_range(table(spark, folder, "lineitem"), "l_orderkey")


def component_counts(spark, folder):
    """Clean and distinct feedback per component: the flagship."""
    clean = R.spam_filter(as_feedback(spark, folder))
    distinct = R.first_copies(materialize(clean), "translated", "id")
    table_ = J.settled(X.component_keywords(categories(spark)).select("store", "keyword", "component").distinct())
    pairs = M.keyword_pairs(table_.select("store", "keyword").distinct())
    found = M.find_words(distinct, pairs, "translated", ["id"], X_.STOP)
    return (
        found.join(M.with_sides(table_), ["store", "keyword"])
        .select("id", "store", "component").distinct()
        .groupBy("store", "component").agg(F.count("*").alias("reviews"))
    )


_ALL = [
    pii_detect, pii_scrub, spam_flags, spam_two_passes, dedup_exact, clean_pipeline,
    device_store, version_extract, country_recode, normalize_union, read_feedback_files, source_kind,
    keyword_split, dictionary_scan, issue_dictionary_scan, word_list, unique_words,
    sink_rows, persisted_roundtrip, incremental_load, load_snapshot, load_once, compacted_lookup, translation_memory, html_unescape, sentiment_label,
    dense_ids, batch_id_base, high_water_mark, incremental_filter, forward_fill, stage_counts, distinct_labels,
    tokenize_count, normalize_text, term_freq, word_freq, clean_term_freq, top_terms, group_top_terms,
    review_top_terms, list_freq, surface_mode,
    pair_expand, negation_expand, synonym_expand, word_similarity, component_keywords,
    proximity_match, find_words, find_in_parts, fallback_issue, sentence_split, sentence_windows,
    keyword_context, phrase_chunks, phrase_text, categorize, generic_component_drop, key_issues,
    tfidf, tfidf_over_loads, cosine_pairs, clusters, cluster_summary, group_summary, cluster_keywords, merged_words,
    bottom_up_issues, preprocess, report, order_report, id_lookup, id_range, component_counts,
]


def _tuned(query):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(tune(spark), folder)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {q.__name__: _tuned(q) for q in _ALL}
