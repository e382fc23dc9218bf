"""Operator 7: secrets by patterns and a battery of randomness tests.

Base spans follow three patterns. The method adds tokens that look random. The encoding
of a long token (hexadecimal, base 32, 36 or 64) is inferred from its signs. If the token
is random, its signs are uniform over that alphabet (chi-squared over parts of it), change between halves as often as chance does (runs), and do not follow from
the one before (serial correlation). The three p-values are combined (Fisher).

Natural words can pass short tests by chance, more so when short. So the combined value
is compared with that of all tokens of the corpus without digits, which are taken for
natural, of the same class of length or shorter, under alphabets of the same kind: the
share of them that look as random is a token's p-value, and in each class the false-discovery rate is held at ``RATE`` by the
step-up rule over a histogram. Both come from all documents; the histogram is bounded.

All of it is column expressions. Texts are read once, and only numbers are kept.

Defined results: null text is empty and has no spans; repeated rows are searched each
for itself; an empty table gives no rows. Signs U+0001 and U+0002 count as any control.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from murmur.session import materialize

# The base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/_-]{16,}"

KINDS = ("assign", "access", "hex")
RATE = 0.01
#: Classes of length begin here; bins of the combined value, in tenths of a power of ten.
CLASSES = (16, 20, 24, 32, 48)
BINS = 60
_OPEN, _CLOSE = "\x01", "\x02"
#: Matches of one text are added up in runs of this many.
RUN = 256


def _found(text: Column, pattern: str, group: str = "") -> Column:
    """array<struct<start, match, more>> of all matches; start counts code points from 0."""
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(f"{_OPEN}$0{_CLOSE}{group}"))
    return F.split(marked, _OPEN)


def _spans(pieces: str, group: bool = False) -> str:
    """From the pieces of a marked text: start and match of each.

    A piece is match, mark, (group, mark,) rest. Starts are added up run by run, so that
    a text with very many matches does not copy what is found for each of them.
    """
    rest = f"substring(x, length(substring_index(x, '{_CLOSE}', {1 + group})) + 2)"
    match = f"substring_index(x, '{_CLOSE}', 1)"
    more = f"substring_index(substring_index(x, '{_CLOSE}', 2), '{_CLOSE}', -1)" if group else "''"
    one = f"""
        named_struct('at', r.at + length({match}) + length({rest}),
            'out', concat(r.out, array(named_struct('start', r.at, 'match', {match}, 'more', {more}))))"""
    empty = "CAST(array() AS array<struct<start: int, match: string, more: string>>)"
    runs = f"transform(sequence(0, CAST((size({pieces}) - 2) / {RUN} AS int)), k -> slice({pieces}, k * {RUN} + 2, {RUN}))"
    inner = f"aggregate(run, named_struct('at', s.at, 'out', {empty}), (r, x) -> {one})"
    outer = f"transform(array({inner}), d -> named_struct('at', d.at, 'out', concat(s.out, array(d.out))))[0]"
    start = f"named_struct('at', length({pieces}[0]), 'out', CAST(array() AS array<array<struct<start: int, match: string, more: string>>>))"
    return f"IF(size({pieces}) > 1, flatten(aggregate({runs}, {start}, (s, run) -> {outer}).out), {empty})"


def _tail(z: str) -> str:
    """Upper tail of the normal distribution (Abramowitz and Stegun 7.1.26)."""
    x = f"(abs({z}) / sqrt(2))"
    t = f"(1 / (1 + 0.3275911 * {x}))"
    poly = f"({t} * (0.254829592 + {t} * (-0.284496736 + {t} * (1.421413741 + {t} * (-1.453152027 + {t} * 1.061405429)))))"
    upper = f"(0.5 * {poly} * exp(-{x} * {x}))"
    return f"greatest(1e-15, CASE WHEN {z} >= 0 THEN {upper} ELSE 1 - {upper} END)"


# Alphabets in the order of the values that their signs stand for, and how
# many of their signs make each part of the chi-squared test.
ALPHABETS = {
    "hex": ("0123456789abcdef", (4, 4, 4, 4)),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", (8, 8, 8, 8)),
    "base36": ("0123456789abcdefghijklmnopqrstuvwxyz", (10, 9, 9, 8)),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", (13, 13, 13, 13, 12)),
}


def _alphabet(name: str, upper: bool = False) -> str:
    signs, parts = ALPHABETS[name]
    group = int(name == "base64")
    return f"named_struct('signs', '{signs.upper() if upper else signs}', 'parts', array({', '.join(map(str, parts))}), 'group', {group})"


def _battery(tokens: str) -> str:
    """array<struct<start, size, natural, group, class, bin>> of tokens.

    A token with a digit has the encoding that is inferred. One without is natural and is
    held against every alphabet that it could belong to, apart from hexadecimal: those of
    one case in group 0 and base 64 in group 1.
    """
    inferred = f"""CASE WHEN x.match RLIKE '^[0-9a-f]+$' THEN {_alphabet('hex')}
        WHEN x.match RLIKE '^[0-9A-F]+$' THEN {_alphabet('hex', True)}
        WHEN x.match RLIKE '^[A-Z2-7]+$' THEN {_alphabet('base32')}
        WHEN x.match RLIKE '^[a-z0-9]+$' THEN {_alphabet('base36')}
        ELSE {_alphabet('base64')} END"""
    both = f"""CASE WHEN x.match RLIKE '^[A-Z]+$' THEN array({_alphabet('base32')}, {_alphabet('base64')})
        WHEN x.match RLIKE '^[a-z]+$' THEN array({_alphabet('base36')}, {_alphabet('base64')})
        ELSE array({_alphabet('base64')}) END"""
    letter, digit = "x.match RLIKE '[A-Za-z]'", "x.match RLIKE '[0-9]'"
    kept = f"filter({tokens}, x -> {letter})"
    # Each step keeps what the next needs, so nothing is worked out twice.
    s1 = f"""flatten(transform({kept}, x -> transform(IF({digit}, array({inferred}), {both}), e -> named_struct(
        'start', x.start, 'match', translate(x.match, '-_', '+/'), 'natural', NOT ({digit}), 'e', e))))"""
    s2 = f"transform({s1}, x -> named_struct('start', x.start, 'natural', x.natural, 'e', x.e, 'k', length(x.e.signs), 'v', transform(filter(split(x.match, ''), c -> c != ''), c -> instr(x.e.signs, c) - 1)))"
    s3 = f"transform({s2}, x -> named_struct('start', x.start, 'natural', x.natural, 'e', x.e, 'k', x.k, 'v', x.v, 'n', size(x.v)))"
    # Of a part: the signs before it, its size, and how many of the token's signs lie in it.
    before = "aggregate(slice(x.e.parts, 1, p), 0, (s, w) -> s + w)"
    inside = f"size(filter(x.v, i -> i >= {before} AND i < {before} + x.e.parts[p]))"
    chi = f"aggregate(transform(sequence(0, size(x.e.parts) - 1), p -> CAST({inside} AS double) * {inside} * x.k / x.e.parts[p]), 0D, (s, c) -> s + c) / x.n - x.n"
    sums = """aggregate(x.v, named_struct('s', 0D, 'ss', 0D, 'lag', 0D, 'last', CAST(NULL AS int), 'runs', 0, 'high', 0), (s, i) -> named_struct(
        's', s.s + i, 'ss', s.ss + i * i, 'lag', s.lag + coalesce(s.last, 0) * i, 'last', i,
        'runs', s.runs + IF(s.last IS NULL OR (s.last * 2 < x.k) != (i * 2 < x.k), 1, 0), 'high', s.high + IF(i * 2 < x.k, 0, 1)))"""
    s4 = f"transform({s3}, x -> named_struct('start', x.start, 'natural', x.natural, 'group', x.e.group, 'n', x.n, 'df', size(x.e.parts) - 1D, 'first', x.v[0], 'u', {sums}, 'chi', greatest(0D, {chi})))"
    high, low = "x.u.high", "(x.n - x.u.high)"
    mean_runs = f"(1 + 2D * {high} * {low} / x.n)"
    var_runs = f"(2D * {high} * {low} * (2D * {high} * {low} - x.n) / (1D * x.n * x.n * (x.n - 1)))"
    var = "(x.u.ss - x.u.s * x.u.s / x.n)"
    lagged = "(x.u.lag + x.u.last * x.first - x.u.s * x.u.s / x.n)"
    s5 = f"""transform({s4}, x -> named_struct('start', x.start, 'natural', x.natural, 'group', x.group, 'n', x.n,
        'c', (cbrt(x.chi / x.df) - (1 - 2 / (9 * x.df))) / sqrt(2 / (9 * x.df)),
        'r', IF({var_runs} > 0, abs(x.u.runs - {mean_runs}) / sqrt({var_runs}), 9D),
        's', IF({var} > 0, abs({lagged} / {var} + 1D / x.n) * sqrt(x.n), 9D)))"""
    s6 = f"""transform({s5}, x -> named_struct('start', x.start, 'natural', x.natural, 'group', x.group, 'n', x.n,
        'h', -ln({_tail('x.c')}) - ln(least(1D, 2 * {_tail('x.r')})) - ln(least(1D, 2 * {_tail('x.s')}))))"""
    # Fisher: upper tail of chi-squared with six degrees of freedom at twice h, in closed form.
    value = "(-(-x.h + ln(1 + x.h + x.h * x.h / 2)) / ln(10))"
    class_ = " + ".join(f"IF(x.n >= {c}, 1, 0)" for c in CLASSES[1:])
    return f"""transform({s6}, x -> named_struct('start', x.start, 'size', x.n, 'natural', x.natural, 'group', x.group, 'class', {class_},
        'bin', least({BINS - 1}, greatest(0, CAST({value} * 10 AS int)))))"""


def search(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, tokens) of every row: base spans, and tokens with their battery."""
    plain = F.coalesce(F.col(text), F.lit(""))
    clean = F.when(plain.rlike(f"[{_OPEN}{_CLOSE}]"), F.translate(plain, _OPEN + _CLOSE, "\x03\x03")).otherwise(plain)
    pieces = docs.select(F.col(key), clean.alias("_t")).select(
        key,
        _found(F.col("_t"), ASSIGN, f"$1{_CLOSE}").alias("_assign"),
        _found(F.col("_t"), ACCESS).alias("_access"),
        _found(F.col("_t"), HEX).alias("_hex"),
        _found(F.col("_t"), TOKEN).alias("_token"),
    )

    def base(kind: str, where: str = "true") -> str:
        spans = f"filter({_spans(f'_{kind}', kind == 'assign')}, x -> {where})"
        order = KINDS.index(kind)
        return f"transform({spans}, x -> named_struct('start', x.start, 'kind', {order}, 'end', x.start + length(x.match)))"

    parts = [base("assign", "length(x.more) >= 12"), base("access"), base("hex")]
    return pieces.select(
        key,
        F.expr(f"array_sort(concat({', '.join(parts)}))").alias("base"),
        F.expr(_battery(_spans("_token"))).alias("tokens"),
    )


def last_bins(searched: DataFrame) -> DataFrame:
    """(group, class, last): up to which bin tokens with digits count as discoveries.

    At most one row of each class in a group. Natural tokens of a class or a shorter one
    say how often chance makes a value as random; smaller bins are more random.
    """
    one = searched.select(F.explode("tokens").alias("t")).select("t.group", "t.class", "t.bin", "t.natural")
    counts = one.groupBy("group", "class", "bin").agg(
        F.count(F.when(F.col("natural"), 1)).alias("nulls"), F.count(F.when(~F.col("natural"), 1)).alias("found")
    )
    place = F.col("id")
    every = searched.sparkSession.range(2 * len(CLASSES) * BINS).select(
        F.floor(place / (len(CLASSES) * BINS)).cast("int").alias("group"),
        (F.floor(place / BINS) % len(CLASSES)).cast("int").alias("class"),
        (place % BINS).cast("int").alias("bin"),
    )
    filled = every.join(counts, ["group", "class", "bin"], "left").na.fill(0)
    # A class takes the nulls of shorter ones too, which look random more often.
    shorter = W.partitionBy("group", "bin").orderBy("class")
    pooled = filled.withColumn("nulls", F.sum("nulls").over(shorter))
    up = W.partitionBy("group", "class").orderBy("bin")
    whole = W.partitionBy("group", "class")
    sums = pooled.select(
        "group", "class", "bin",
        ((F.sum("nulls").over(up) + 1) / (F.sum("nulls").over(whole) + 1)).alias("p"),
        F.sum("found").over(up).alias("so_far"), F.sum("found").over(whole).alias("all"),
    )
    passed = sums.filter((F.col("so_far") > 0) & (F.col("p") * F.col("all") <= RATE * F.col("so_far")))
    return passed.groupBy("group", "class").agg(F.max("bin").alias("last"))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_assign, n_access, n_hex, n_random, base_sha256, spans) of every row."""
    searched = materialize(search(docs, key, text))
    # A number for each class of length in each group.
    last = {(r["group"], r["class"]): r["last"] for r in last_bins(searched).collect()}
    limits = ", ".join(str(last.get((g, c), -1)) for g in range(2) for c in range(len(CLASSES)))
    names = "array('" + "', '".join([*KINDS, "random"]) + "')"
    added = f"""transform(filter(tokens, t -> NOT t.natural AND t.bin <= array({limits})[t.group * {len(CLASSES)} + t.class]
        AND NOT exists(base, b -> b.start < t.start + t.size AND t.start < b.end)),
        t -> named_struct('start', t.start, 'kind', {len(KINDS)}, 'end', t.start + t.size))"""
    joined = "array_join(transform({0}, x -> concat({1}[x.kind], ':', x.start, ':', x.end)), ',')"
    out = searched.withColumn("_added", F.expr(added))
    return out.select(
        key,
        *[F.expr(f"CAST(size(filter(base, x -> x.kind = {i})) AS bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.size("_added").cast("long").alias("n_random"),
        F.sha2(F.expr(joined.format("base", names)), 256).alias("base_sha256"),
        F.expr(joined.format("array_sort(concat(base, _added))", names)).alias("spans"),
    )
