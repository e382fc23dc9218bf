"""Words, normal forms, sentences and word windows, as column expressions."""

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from murmur import fixed


def words(text: Column, pattern: str = fixed.WORD) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it.
    Inside higher-order functions a plain expression would be computed per element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _fold_plural(w: Column) -> Column:
    def cut(n: int, ending: str) -> Column:
        return F.concat(F.substring(w, F.lit(1), F.length(w) - n), F.lit(ending))

    def ends(*endings: str) -> Column:
        test = w.endswith(endings[0])
        for e in endings[1:]:
            test = test | w.endswith(e)
        return test

    return (
        F.when(~w.endswith("s"), w)
        .when(ends("ies") & ~ends("eies", "aies"), cut(3, "y"))
        .when(ends("es") & ~ends("aes", "ees", "oes"), cut(1, ""))
        .when(~ends("us", "ss"), cut(1, ""))
        .otherwise(w)
    )


def normal_form(word: Column) -> Column:
    """Lower case, plural endings folded (the S-stemmer: Harman, 1991)."""
    return _fold_plural(F.lower(word))


def normal_forms(items: Column) -> Column:
    return F.transform(F.transform(items, lambda w: F.lower(w)), _fold_plural)


def normal_python(word: str) -> str:
    """``normal_form`` of one word of a word list held by the driver."""
    w = word.lower()
    if w.endswith("ies") and not w.endswith(("eies", "aies")):
        return w[:-3] + "y"
    if w.endswith("es") and not w.endswith(("aes", "ees", "oes")):
        return w[:-1]
    if w.endswith("s") and not w.endswith(("us", "ss")):
        return w[:-1]
    return w


def normal_stop(stop: list[str]) -> list[str]:
    return list(dict.fromkeys(normal_python(w) for w in stop))


def is_kept(term: Column, stop: list[str]) -> Column:
    return ~term.isin(stop) if stop else F.lit(True)


def terms(text: Column, stop: list[str] = ()) -> Column:
    """Normal forms of a text's words in order, stop words dropped."""
    return terms_of(words(text), stop)


def terms_of(items: Column, stop: list[str] = ()) -> Column:
    """``terms`` of a list of words."""
    normal = normal_forms(items)
    stop = normal_stop(list(stop))
    return F.filter(normal, lambda t: is_kept(t, stop)) if stop else normal


def sentences(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), fixed.SENTENCE_END, -1)


def windows(items: Column, length: int = 2) -> Column:
    """Runs of ``length`` neighbours, stride 1; a short list is one run."""

    def runs(xs: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(xs) - (length - 1))
        return F.when(
            F.size(xs) > length, F.transform(starts, lambda i: F.slice(xs, i, length))
        ).otherwise(F.array(xs))

    return bind(items, runs)


def contexts(text: Column, targets: Column, before: int = 2) -> Column:
    """``struct(term, context)`` for each word whose normal form is among ``targets``:
    the word and those just before it in its sentence. One pass over the text, however
    many targets there are."""

    def of_sentence(ws: Column) -> Column:
        first = lambda i: F.greatest(i - before, F.lit(0))
        context = lambda i: F.array_join(F.slice(ws, first(i) + 1, i - first(i) + 1), " ")
        hit = lambda t, i: F.named_struct(F.lit("term"), t, F.lit("i"), i)
        hits = F.filter(
            F.transform(normal_forms(ws), hit), lambda h: F.array_contains(targets, h["term"])
        )
        return F.transform(
            hits,
            lambda h: F.named_struct(F.lit("term"), h["term"], F.lit("context"), context(h["i"])),
        )

    return F.flatten(
        F.transform(F.transform(sentences(text), lambda s: words(s)), of_sentence)
    )


def neighbourhoods(items: Column) -> Column:
    """Each item with those from two places before it to one place after it."""

    def near(xs: Column, i: Column) -> Column:
        start = F.greatest(i - 1, F.lit(1))
        return F.slice(xs, start, i + 3 - start)

    return bind(
        items,
        lambda xs: F.transform(
            xs, lambda t, i: F.named_struct(F.lit("term"), t, F.lit("near"), near(xs, i))
        ),
    )
