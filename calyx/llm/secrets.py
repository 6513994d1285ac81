"""Secret scan in DataFrame functions: base patterns, and Markov models of characters.

Match places come from ``split`` (the text between matches) and
``regexp_extract_all`` (the matches): their lengths add up to code-point
offsets. Long tokens outside base matches are scored by two first-order Markov
models over characters, one of random strings, one of ordinary identifiers; the
log-likelihood ratio decides. Both are counted from labelled tokens of all
documents: those that base matches cover, and generated random strings, are
random; of the others those made of words and numbers are ordinary, and the rest, the tokens
in question, trains nothing. Counts are bounded by the alphabet, so the model is
a literal array in the plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import write_table

#: fixed values: kind, pattern, least characters of the group that is checked, group, a cheap first test
_VALUE = "[A-Za-z0-9+/_.=-]+"
ASSIGN = rf"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?({_VALUE})"""
ACCESS = r"AKIA[A-Z0-9]{16,}"            # AKIA[A-Z0-9]+ of 20 characters or more
HEX = r"[0-9a-f]{24,}"                   # [0-9a-f]+ of 24 or more
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
#: a token that is made of words, or a plain number, which labels it ordinary; possessive: a long token is read once
WORDS = r"^(?:(?:[_/=+-]*+(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+)[0-9]{0,3}+)++[_/=+-]*+|[0-9/_=+-]++)$"
SIZE = len(ALPHABET) + 1                 # place 0 stands before the first character
MARGIN = 8.0                             # least log-likelihood ratio of a reported token
BACKING = 5.0
GENERATED = 20_000                       # random strings that train the random model besides the corpus

BLOCK = 128                              # matches whose places are summed up together

_SPAN = "array<struct<s:int,e:int,v:string>>"
#: whether a base span touches the token t: of each kind, whose spans follow one another, the last one that
#: begins before the token's end is found by bisection
_COVERED = " OR ".join(f"""(size({kind}) > 0 AND aggregate(
        sequence(1, cast(ceil(log2(size({kind}) + 1)) AS int)), named_struct('lo', 0, 'hi', size({kind})),
        (r, i) -> CASE WHEN r.lo >= r.hi THEN r
                       WHEN {kind}[(r.lo + r.hi) div 2].s < t.e THEN named_struct('lo', cast((r.lo + r.hi) div 2 AS int) + 1, 'hi', r.hi)
                       ELSE named_struct('lo', r.lo, 'hi', cast((r.lo + r.hi) div 2 AS int)) END,
        r -> r.lo > 0 AND element_at({kind}, greatest(r.lo, 1)).e > t.s))""" for kind in ("assign", "access", "hex"))


def _spans(text: str, pattern: str, group: int, gate: Column, prefix: str) -> tuple[dict, Column]:
    """Columns to add first, and the spans (s, e, v: the group) from them; no span where ``gate`` fails."""
    need = {f"{prefix}_gaps": F.when(gate, F.split(text, pattern, -1)),
            f"{prefix}_hits": F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))),
            f"{prefix}_vals": F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))}
    g, h, v = need
    # Places are running sums of lengths, which SQL gathers by appending: in blocks of BLOCK matches, each of
    # which begins where the blocks before it end, so that no long array is copied match by match. A transform of
    # a one-element array names what lambdas use: the optimiser would otherwise put its expression into them.
    begins = """aggregate(
        transform(sequence(0, (size(x.h) - 1) div {B}), b -> aggregate(slice(y.n, b * {B} + 1, {B}), 0, (a, n) -> a + n)),
        named_struct('at', 0, 'all', cast(array() AS array<int>)),
        (acc, n) -> named_struct('at', acc.at + n, 'all', concat(acc.all, array(acc.at))), acc -> acc.all)"""
    block = """aggregate(
        sequence(b * {B}, least(size(x.h), (b + 1) * {B}) - 1), named_struct('at', z.o[b], 'spans', cast(array() AS {SPAN})),
        (acc, i) -> named_struct('at', acc.at + y.n[i], 'spans', concat(acc.spans, array(named_struct(
            's', acc.at + y.g[i], 'e', acc.at + y.n[i], 'v', x.v[i])))),
        acc -> acc.spans)"""
    spans = f"""CASE WHEN size({h}) > 0 THEN
        transform(array(named_struct('g', slice({g}, 1, size({h})), 'h', {h}, 'v', {v})), x ->
        transform(array(named_struct('g', transform(x.g, a -> length(a)),
                                     'n', zip_with(x.g, x.h, (a, b) -> length(a) + length(b)))), y ->
        transform(array(named_struct('o', {begins})), z ->
        flatten(transform(sequence(0, (size(x.h) - 1) div {{B}}), b -> {block})))[0])[0])[0]
        ELSE cast(array() AS {{SPAN}}) END"""
    return need, F.expr(spans.replace("{B}", str(BLOCK)).replace("{SPAN}", _SPAN))


def base_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, assign, access, hex, tokens): spans of each kind, and of long tokens, per row."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    plan = {"assign": (ASSIGN, 2, F.col("text").rlike("(?i)password|passwd|secret|token|api_?key")),
            "access": (ACCESS, 0, F.col("text").contains("AKIA")),
            "hex": (HEX, 0, F.col("text").rlike("[0-9a-f]{24}")),
            "tokens": (TOKEN, 0, F.col("text").rlike("[A-Za-z0-9+/_=-]{16}"))}
    parts = {k: _spans("text", p, g, gate, k) for k, (p, g, gate) in plan.items()}
    wide = base.withColumns({name: c for need, _ in parts.values() for name, c in need.items()})
    found = wide.select("id", *(spans.alias(k) for k, (_, spans) in parts.items()))
    return found.withColumn("assign", F.filter("assign", lambda x: F.length(x["v"]) >= 6))


def _pairs(tokens: DataFrame) -> DataFrame:
    """(side, a, b, n): weighted character transitions of (side, token, n)."""
    codes = F.expr(f"transform(sequence(1, length(token)), i -> instr('{ALPHABET}', substring(token, i, 1)))")
    steps = F.expr("transform(codes, (c, i) -> named_struct('a', CASE WHEN i = 0 THEN 0 ELSE codes[i - 1] END, 'b', c))")
    return tokens.withColumn("codes", codes).select("side", "n", F.explode(steps).alias("p")) \
        .groupBy("side", "p.a", "p.b").agg(F.sum("n").alias("n"))


def generated(spark: SparkSession, n: int = GENERATED) -> DataFrame:
    """Labelled random strings: hashes as hexadecimal, Base64 and Base32-like text, made by Spark."""
    h = F.sha2(F.col("id").cast("string"), 256)
    text = F.when(F.col("id") % 3 == 0, F.substring(h, 1, 40)) \
        .when(F.col("id") % 3 == 1, F.substring(F.base64(F.unhex(h)), 1, 40)) \
        .otherwise(F.regexp_replace(F.upper(F.substring(F.base64(F.unhex(h)), 1, 24)), "[+/=]", "7"))
    return spark.range(n).select(F.lit("random").alias("side"), text.alias("token"), F.lit(1).cast("long").alias("n"))


def log_ratios(counts: list[tuple]) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary) at a * SIZE + b, from (side, a, b, n).

    Transitions are smoothed towards how often b comes at all, as if each row
    had BACKING more characters.
    """
    n = {s: [[0.0] * SIZE for _ in range(SIZE)] for s in ("random", "ordinary")}
    for side, a, b, k in counts:
        n[side][a][b] += k
    chance = {}
    for side, rows in n.items():
        every = [sum(r[b] for r in rows) + 0.1 for b in range(SIZE)]
        every = [x / sum(every) for x in every]
        chance[side] = [[(r[b] + BACKING * every[b]) / (sum(r) + BACKING) for b in range(SIZE)] for r in rows]
    return [math.log(x / y) for a in range(SIZE) for x, y in zip(chance["random"][a], chance["ordinary"][a])]


def train(spans: DataFrame) -> list[float]:
    """The models' log ratios from all long tokens of ``base_spans``, labelled by base cover."""
    told = f"transform(tokens, t -> named_struct('token', t.v, 'covered', {_COVERED}))"
    tokens = spans.select(F.explode(F.expr(told)).alias("t")).select(
        F.when(F.col("t.covered"), "random").when(F.col("t.token").rlike(WORDS), "ordinary").alias("side"),
        F.col("t.token").alias("token")).filter("side is not null")
    # a common token is one row before its characters are counted
    tokens = tokens.groupBy("side", "token").agg(F.count("*").alias("n"))
    # each distinct token counts once: a copied document isn't more evidence
    tokens = tokens.withColumn("n", F.lit(1).cast("long")).unionByName(generated(spans.sparkSession))
    return log_ratios([tuple(r) for r in _pairs(tokens).collect()])          # at most 2 * SIZE ** 2 rows


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    ordered = F.array_sort(spans)
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 margin: float = MARGIN) -> DataFrame:
    """(id, found): per row, spans (s, k, e, score) in code points, the end exclusive, k the kind's place in KINDS.

    Base kinds: leftmost matches that don't overlap within their kind, those
    too short dropped; an assignment's span is its whole match. Kind markov: a
    run of 16 or more of A-Z a-z 0-9 + / _ = - that no base span touches, whose
    log-likelihood ratio of random against ordinary is ``margin`` or more
    (score; null for base kinds). Null and empty texts have no spans; repeated
    rows and null ids are answered row by row; an empty table gives no rows.
    Only the two named columns are read. The spans of one text are gathered in
    one row, in time that grows with their number times its logarithm.
    """
    spans = write_table(base_spans(docs, id_col, text_col), "spans")
    table = train(spans)
    ratios = "array(" + ",".join(f"{x!r}D" for x in table) + ")"
    ratio = f"""aggregate(transform(sequence(1, length(t.v)), i -> instr('{ALPHABET}', substring(t.v, i, 1))),
        named_struct('a', 0, 'sum', 0D),
        (acc, b) -> named_struct('a', b, 'sum', acc.sum + element_at(ratios, acc.a * {SIZE} + b + 1)),
        acc -> acc.sum)"""
    free = f"filter(tokens, t -> NOT ({_COVERED}))"
    own = f"transform({free}, t -> named_struct('s', t.s, 'k', 3, 'e', t.e, 'score', {ratio}))"
    kinds = [f"transform({c}, x -> named_struct('s', x.s, 'k', {k}, 'e', x.e, 'score', cast(null AS double)))"
             for k, c in enumerate(KINDS[:3])]
    return spans.withColumn("ratios", F.expr(ratios)).select(
        "id", F.expr(f"concat({', '.join(kinds)}, filter({own}, x -> x.score >= {margin}D))").alias("found"))


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_markov, base_sha256, spans) per row of ``find_secrets``."""
    found = find_secrets(docs, id_col, text_col, **how)
    count = lambda k: F.size(F.filter("found", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "id", *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(_joined(F.filter("found", lambda x: x["k"] < 3)), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"))
