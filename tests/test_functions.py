"""Expression semantics on hand-made cases."""

import re

from pyspark.sql import functions as F

from murmur import fixed
from murmur.functions import agent, cleaning, text as T, values as V


IOS, WEB = fixed.VERSION_MARKERS


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first().x


def each(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def test_last_listed_device_wins(spark):
    agents = ["iPhone Windows", "Linux iPad", "other", None, "iPad"]
    assert each(spark, agents, agent.device(F.col("t"))) == ["Windows", "Linux", "Unknown", "Unknown", "iPad"]
    stores = each(spark, agents, agent.store_of(agent.device(F.col("t"))))
    assert stores == ["Desktop", "Desktop", "", "", "iOS"]


def test_version_forms(spark):
    cases = {
        f"X {IOS}10.0b6373 Y": 10.0,
        f"X {IOS}10.0.1 Y": 10.0,
        f"X {WEB}57.0": 57.0,
        f"X {IOS}8.1 {WEB}57.0": 8.1,
        f"{IOS}10.0": 0.0,
        f"{IOS}10.0 {WEB}3.5": 3.5,
        f"X {IOS}abc {WEB}3.5": 0.0,
        f"X {WEB}57": 0.0,
        "nothing": 0.0,
        f"X {IOS}10.10": 10.1,
    }
    assert each(spark, list(cases), agent.version(F.col("t"))) == list(cases.values())


def python_scrub(text):
    email, phone = fixed.PYTHON_EMAIL, fixed.PYTHON_PHONE
    while re.search(email, text) or re.search(phone, text):
        text = re.sub(phone, "", re.sub(email, "", text))
    return text


def test_scrub_reaches_a_fixed_point(spark):
    joined = "123(345) 678-90124567" * 12
    nested = "(345) 678-9012"
    for _ in range(9):
        nested = "123" + nested + "4567"  # 1234567 only after the inner one is gone
    texts = [
        "mail a.b@c.de or 555-1234 now", "a@(123) 456 7890b", "(123) 456 7890", "é@ü.x", "123 456 7890 12",
        joined, nested, "no data", "", "x@y@z", "٣٤٥٦٧٨٩",
    ]
    got = each(spark, texts, cleaning.scrub(F.col("t")))
    assert got == [python_scrub(t) for t in texts]
    left = each(spark, got, cleaning.has_personal_data(F.col("t")))
    assert not any(left)


def test_spam_rules(spark):
    long_text = "word " * 201
    cases = {
        "fine": False,
        fixed.NO_LANGUAGE: True,
        long_text: True,
        long_text + " browser and browser": False,
        long_text + " browser a@browser.com": True,  # one mention goes with the address
        "1 " * 31: True,
        "1 " * 30: False,
        "x" * 1000: False,
    }
    got = each(spark, list(cases), cleaning.screen(F.col("t"))["spam"])
    assert got == list(cases.values())
    assert one(spark, cleaning.screen(F.col("t"))["spam"], t=None) is True


def test_normal_form_agrees_with_its_python_twin(spark):
    words = "queries pies eies aies buses aes toes trees class bus cats s es ies Dogs Éclairs".split()
    assert each(spark, words, T.normal_form(F.col("t"))) == [T.normal_python(w) for w in words]


def test_words_are_unicode(spark):
    assert one(spark, T.words(F.col("t")), t="Él çà_1 can't x-y ²") == re.findall(r"\w+", "Él çà_1 can't x-y ²")


def test_sentences(spark):
    texts = ["It works. Mr. X said a.b. no? Yes! Fine. ", "", "one", "A.  B", "tab.\tend?\nlast"]
    assert each(spark, texts, T.sentences(F.col("t"))) == [re.split(fixed.PYTHON_SENTENCE_END, t) for t in texts]


def test_windows(spark):
    items = F.split(F.col("t"), ",")
    assert one(spark, T.windows(items, 2), t="a,b,c") == [["a", "b"], ["b", "c"]]
    assert one(spark, T.windows(items, 2), t="a,b") == [["a", "b"]]
    assert one(spark, T.windows(items, 3), t="a") == [["a"]]


def test_contexts(spark):
    text = "The big red car stops. Cars go. A car"
    found = one(spark, T.contexts(F.col("t"), F.array(F.lit("car"), F.lit("go"))), t=text)
    assert [tuple(f) for f in found] == [
        ("car", "big red car"), ("car", "Cars"), ("go", "Cars go"), ("car", "A car")
    ]


def test_values(spark):
    assert one(spark, V.split_list(F.col("t")), t=" a,, b ,  c d,") == ["a", "b", "c d"]
    assert one(spark, V.recode(F.col("t")), t="USA") == "United States"
    assert one(spark, V.recode(F.col("t")), t="USA!") == "USA!"
    assert one(spark, V.stored_text(F.col("t")), t="a|b" + "x" * 5000) == "a b" + "x" * 3997
    assert one(spark, V.unescape(F.col("t")), t="it&#39;s") == "it's"
    dates = each(spark, ["2018-05-10", "5/9/2018", "2018-05-10 10:11:12", "May 3, 2018", "x", ""], V.to_date(F.col("t")).cast("string"))
    assert dates == ["2018-05-10", "2018-05-09", "2018-05-10", "2018-05-03", None, None]


def test_sentiment_bands(spark):
    df = spark.createDataFrame([(0.2, 0.25), (0.15, 1.0), (0.2, 0.3), (-0.2, 0.3)], "s double, m double")
    got = [r[0] for r in df.select(V.sentiment_label(F.col("s"), F.col("m"))).collect()]
    assert got == ["Neutral", "Neutral", "Positive", "Negative"]
