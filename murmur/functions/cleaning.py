"""Personal data and spam, as column expressions."""

from pyspark.sql import Column, functions as F

from murmur import fixed


def has_email(text: Column) -> Column:
    # The plain substring test spares most texts the pattern.
    return text.contains("@") & text.rlike(fixed.EMAIL)


def has_phone(text: Column) -> Column:
    return text.rlike(fixed.PHONE)


def has_personal_data(text: Column) -> Column:
    return has_email(text) | has_phone(text)


def too_long(text: Column) -> Column:
    """Long and hardly about the topic."""
    return (F.length(text) > fixed.MAX_CHARS) & (
        F.regexp_count(text, F.lit(fixed.TOPIC)) < fixed.MIN_TOPIC_MENTIONS
    )


def too_many_numbers(text: Column) -> Column:
    runs = F.regexp_count(text, F.lit(fixed.DIGIT + "+"))
    return runs > fixed.MAX_DIGIT_RUNS


def no_language(text: Column) -> Column:
    return text.isNull() | (text == fixed.NO_LANGUAGE)


def _breaks_a_rule(text: Column) -> Column:
    return too_long(text) | too_many_numbers(text) | no_language(text)


def _remove_once(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, fixed.EMAIL, ""), fixed.PHONE, "")


def screen(text: Column) -> Column:
    """``struct(text, spam)``: text free of personal data, and whether any version
    of it on the way there breaks a spam rule.

    Removing a number can join the pieces around it into a new one, so removal is
    repeated until nothing is found. Every round takes at least three characters,
    which bounds the rounds; a text without personal data takes none.
    """

    def state(value: Column, spam: Column) -> Column:
        return F.struct(
            value.alias("text"), spam.alias("spam"), has_personal_data(value).alias("open")
        )

    def round_(acc: Column, _: Column) -> Column:
        cleaned = _remove_once(acc["text"])
        return F.when(
            acc["open"], state(cleaned, acc["spam"] | _breaks_a_rule(cleaned))
        ).otherwise(acc)

    rounds = F.sequence(F.lit(1), (F.length(text) / 3).cast("int") + 1)
    scrubbed = F.aggregate(
        rounds,
        state(text, _breaks_a_rule(text)),
        round_,
        lambda acc: F.struct(acc["text"].alias("text"), acc["spam"].alias("spam")),
    )
    untouched = F.struct(text.alias("text"), _breaks_a_rule(text).alias("spam"))
    return F.when(has_personal_data(text), scrubbed).otherwise(untouched)


def scrub(text: Column) -> Column:
    return F.when(has_personal_data(text), screen(text)["text"]).otherwise(text)
