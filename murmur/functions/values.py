"""Small value rules: labels, dates, recodes, lists."""

from pyspark.sql import Column, functions as F

from murmur import fixed

DATE_FORMATS = ["yyyy-MM-dd", "M/d/yyyy", "M/d/yyyy H:mm", "MMM d, yyyy", "MMM d, yyyy h:mm:ss a"]


def to_date(text: Column) -> Column:
    parsed = [F.try_to_timestamp(text)]
    parsed += [F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]
    return F.coalesce(*parsed).cast("date")


def date_text(day: Column, american: bool = False) -> Column:
    """A date as persisted: year first, or month first for the second warehouse."""
    return F.date_format(day, "MM-dd-yyyy" if american else "yyyy-MM-dd")


def recode(value: Column, names: dict[str, str] = fixed.COUNTRY_NAMES) -> Column:
    """Replace whole values."""
    result = value
    for old, new in names.items():
        result = F.when(value == old, F.lit(new)).otherwise(result)
    return result


def sentiment_label(score: Column, magnitude: Column) -> Column:
    weak = (F.abs(magnitude) <= fixed.MIN_MAGNITUDE) | (F.abs(score) <= fixed.MIN_SCORE)
    return F.when(weak, "Neutral").when(score > 0, "Positive").otherwise("Negative")


def split_list(text: Column) -> Column:
    """Items of a comma list, trimmed, empty ones dropped."""
    items = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(items, lambda x: x != "")


def stored_text(text: Column) -> Column:
    """Text as persisted: cut to size, pipes turned into blanks."""
    return F.translate(F.substring(text, 1, fixed.MAX_STORED_CHARS), "|", " ")


def unescape(text: Column) -> Column:
    """Apostrophes that came back from translation as HTML."""
    return F.replace(text, F.lit("&#39;"), F.lit("'"))
