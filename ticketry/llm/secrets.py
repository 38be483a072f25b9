"""Secret scans: three fixed rules, and a likelihood-ratio test of two character Markov models for what they miss.

The rules find key assignments, access keys and long hex runs. The models are first-order Markov chains over characters,
one of random strings, one of ordinary identifiers, both trained from labelled samples. A long token that mixes letters
and digits and touches no finding of a rule is a finding of kind ``random`` when the mean log-likelihood ratio of its
character pairs is above ``margin``. Ratios are kept in millionths of a nat, as integers, so sums have no rounding.

Everything is Spark SQL functions: the matches of a pattern and the pieces between them give the offsets, so there is one
pass over the texts without any shuffle. The models are ``SYMBOLS`` squared numbers whatever the corpus.

Defined cases: null text is an empty one (no spans); a null in a sample is left out; with samples of one label only, or
none, the method adds no spans; repeated rows come out as often; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketry.llm.common import written

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: In the order in which findings with the same start are listed.
RULES = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
KINDS = [*RULES, "random"]
#: Tokens are whole runs of these characters; the shortest that the models judge, and that they learn from.
TOKEN_CLASS = "A-Za-z0-9+/_=-"
LEAST_TOKEN, LEAST_SAMPLE, LEAST_VALUE = 20, 12, 8
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
#: Every character outside the alphabet is one more symbol, number 0.
SYMBOLS = len(ALPHABET) + 1
#: Nats a pair that a finding must have at least. Pairs count beside ``BACKOFF`` pairs dealt by how frequent the second
#: character is, and each character counts ``SMOOTHING`` times more than it comes.
MARGIN, BACKOFF, SMOOTHING = 0.5, 5.0, 0.5
MASK = "[SECRET]"
_BLOCK = 256


def token_pattern(least: int) -> str:
    return f"(?<![{TOKEN_CLASS}])[{TOKEN_CLASS}]{{{least},}}+"


def pairs(token: Column) -> Column:
    """The pairs of neighbouring characters of a token, each as one number below ``SYMBOLS`` squared."""
    codes = F.transform(F.split(token, ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c))
    return F.zip_with(codes, F.slice(codes, 2, F.size(codes)), lambda a, b: a * SYMBOLS + b)


def with_matches(df: DataFrame, kind: str, pattern: str, group: int = 0) -> DataFrame:
    """``df`` (column _text) with array column _<kind> of (start, end, value), in order; offsets in code points.

    Starts are running sums of the pieces' lengths, taken by blocks so that very many matches stay cheap.
    """
    text, found, steps, sums = F.col("_text"), f"_{kind}_found", f"_{kind}_steps", f"_{kind}_sums"
    some = F.size(found) > 0
    df = df.withColumn(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    df = df.withColumn(steps, F.when(some, F.zip_with(F.split(text, pattern, -1), found, lambda gap, match: F.struct(
        F.length(gap).alias("gap"), F.length(match).alias("match"))))).withColumn(
        f"_{kind}_values", F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.col(found)))
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, s: a + s["gap"] + F.coalesce(s["match"], F.lit(0)))
    blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _BLOCK).cast("int"))
    df = df.withColumn(f"_{kind}_each", F.when(some, F.transform(blocks, lambda b: total(F.slice(steps, b * _BLOCK + 1, _BLOCK)))))
    df = df.withColumn(sums, F.when(some, F.transform(
        blocks, lambda b: F.aggregate(F.slice(f"_{kind}_each", 1, b), F.lit(0), lambda a, s: a + s))))

    def span(value: Column, i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        start = F.get(sums, block) + total(F.slice(steps, block * _BLOCK + 1, i % _BLOCK)) + F.get(steps, i)["gap"]
        return F.struct(start.alias("start"), (start + F.get(steps, i)["match"]).alias("end"), value.alias("value"))

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    df = df.withColumn(f"_{kind}", F.coalesce(F.when(some, F.transform(f"_{kind}_values", span)), empty))
    return df.drop(found, steps, f"_{kind}_each", sums, f"_{kind}_values")


def with_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with _text and the findings of each rule."""
    df = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    for kind, pattern in RULES.items():
        df = with_matches(df, kind, pattern, group=1 if kind == "assign" else 0)
    return df.withColumn("_assign", F.filter("_assign", lambda s: F.length(s["value"]) >= LEAST_VALUE))


def samples(docs: DataFrame) -> DataFrame:
    """Labelled tokens of a corpus: (token, random). Random: values found by the rules, with a digit. Ordinary: all others."""
    values = F.concat(*[F.transform(f"_{k}", lambda s: s["value"]) for k in RULES])
    random = F.filter(values, lambda v: v.rlike("[0-9]"))
    cut = F.col("_text")
    for pattern in RULES.values():
        cut = F.regexp_replace(cut, pattern, " ")
    rest = F.when(F.size(values) > 0, cut).otherwise(F.col("_text"))
    plain = F.regexp_extract_all(rest, F.lit(token_pattern(LEAST_SAMPLE)), F.lit(0))
    both = F.concat(F.transform(random, lambda v: F.struct(v.alias("token"), F.lit(True).alias("random"))),
                    F.transform(plain, lambda v: F.struct(v.alias("token"), F.lit(False).alias("random"))))
    return with_rules(docs.select("text")).select(F.inline(both))


def train(labelled: DataFrame) -> str | None:
    """The ratios of all character pairs, comma-joined, from rows (token, random); None without samples of both labels."""
    counts = (labelled.where("token IS NOT NULL AND random IS NOT NULL").select("random", F.explode(pairs(F.col("token"))).alias("pair"))
              .where("pair IS NOT NULL").groupBy("pair").agg(
                  F.count(F.when(F.col("random"), 1)).alias("r"), F.count(F.when(~F.col("random"), 1)).alias("o")))
    grid = labelled.sparkSession.range(SYMBOLS * SYMBOLS).select(F.col("id").cast("int").alias("pair"))
    full = grid.join(counts, "pair", "left").select("pair", *[F.coalesce(c, F.lit(0)).alias(c) for c in "ro"])
    row, column, all_pairs = (Window.partitionBy(key) for key in (F.floor(F.col("pair") / SYMBOLS), F.col("pair") % SYMBOLS, F.lit(0)))

    def log_share(c: str) -> Column:
        share = (F.sum(c).over(column) + SMOOTHING) / (F.sum(c).over(all_pairs) + SMOOTHING * SYMBOLS)
        return F.log((F.col(c) + share * BACKOFF) / (F.sum(c).over(row) + BACKOFF))

    log = {c: log_share(c) for c in "ro"}
    ratios = full.select("pair", "r", "o", F.round((log["r"] - log["o"]) * 1e6).cast("long").alias("ratio"))
    model = ratios.agg(F.sum("r"), F.sum("o"), F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("pair", "ratio"))), lambda x: x["ratio"].cast("string")), ",")).first()
    return model[2] if model[0] and model[1] else None


def findings(docs: DataFrame, model: str | None, margin: float = MARGIN) -> DataFrame:
    """``docs`` with _text, _base and _spans: sorted arrays of (start, kind, end), the kind by its number in ``KINDS``."""
    df = with_rules(docs)
    listed = lambda k, n: F.transform(f"_{k}", lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("kind"), s["end"].alias("end")))
    df = df.withColumn("_base", F.array_sort(F.concat(*[listed(k, n) for n, k in enumerate(RULES)])))
    if model is None:
        return df.withColumn("_spans", F.col("_base"))
    df = with_matches(df, "token", token_pattern(LEAST_TOKEN))
    table = F.split(F.lit(model), ",").cast("array<long>")

    def secret(s: Column) -> Column:
        token = s["value"]
        ratio = F.aggregate(pairs(token), F.lit(0).cast("long"), lambda a, p: a + F.coalesce(F.get(table, p), F.lit(0)))
        clear = ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return token.rlike("[0-9]") & token.rlike("[A-Za-z]") & clear & (ratio > F.lit(int(margin * 1e6)) * (F.length(token) - 1))

    df = df.withColumn("_random", F.filter("_token", secret))
    return df.withColumn("_spans", F.array_sort(F.concat("_base", listed("random", len(RULES)))))


def _shown(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, labelled: DataFrame | None = None, margin: float = MARGIN) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans; models from ``labelled`` or from the documents themselves."""
    df = findings(docs.select("doc_id", "text"), train(samples(docs) if labelled is None else labelled), margin)
    count = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return df.select("doc_id", *[count(k) for k in KINDS], F.sha2(_shown("_base"), 256).alias("base_sha256"), _shown("_spans").alias("spans"))


def masked(docs: DataFrame, labelled: DataFrame | None = None, margin: float = MARGIN) -> DataFrame:
    """``docs`` with every finding replaced by ``MASK`` and n_chars, if there, counted anew in the changed texts."""
    df = findings(docs, train(samples(docs) if labelled is None else labelled), margin)
    ends = lambda n: F.coalesce(F.array_max(F.transform(F.slice("_spans", 1, n), lambda s: s["end"])), F.lit(0))
    text = F.col("_text")

    def piece(s: Column, i: Column) -> Column:
        before = ends(i)
        gap = F.substring(text, before + 1, F.greatest(s["start"] - before, F.lit(0)))
        return F.concat(gap, F.when((s["start"] >= before) | (i == 0), F.lit(MASK)).otherwise(F.lit("")))

    clean = F.concat(F.array_join(F.transform("_spans", piece), ""), F.substring(text, ends(F.size("_spans")) + 1, F.length(text)))
    changed = F.size("_spans") > 0
    made = {"text": F.when(changed, clean).otherwise(F.col("text"))}
    df = df.withColumns(made)
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return df.select(*docs.columns)


def _sql_spans(kind: str, pattern: str, value: str) -> str:
    """Rows (doc_id, start, end, value) of a pattern, for an engine without offsets of matches."""
    return f"""{kind}_m AS (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS m, {value} AS v,
  string_split_regex(text, '{pattern}') AS g FROM d WHERE regexp_matches(text, '{pattern}')),
{kind}_u AS (SELECT doc_id, unnest(m) AS m, unnest(v) AS v, unnest(g[1:len(m)]) AS g, generate_subscripts(m, 1) AS i FROM {kind}_m),
{kind} AS (SELECT doc_id, v, sum(len(g) + len(m)) OVER (PARTITION BY doc_id ORDER BY i) - len(m) AS a, sum(len(g) + len(m)) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM {kind}_u)"""


def oracle() -> str:
    """The same findings in SQL, for doc_ids that are unique."""
    assign = ASSIGN.replace("'", "''")
    share = "((sum({{c}}) OVER (PARTITION BY p % {n}))::DOUBLE + {s}) / ((sum({{c}}) OVER ())::DOUBLE + {s} * {n})".format(s=f"{SMOOTHING}::DOUBLE", n=SYMBOLS)
    log = f"ln(({{c}}::DOUBLE + {share} * {BACKOFF}::DOUBLE) / ((sum({{c}}) OVER w)::DOUBLE + {BACKOFF}::DOUBLE))"
    ratio = f"round(({log.format(c='r')} - {log.format(c='o')}) * 1000000)::BIGINT"
    code = f"instr('{ALPHABET}', {{}})"
    pair = f"list_transform(generate_series(1, len(v) - 1), lambda i: {code.format('v[i]')} * {SYMBOLS} + {code.format('v[i + 1]')})"
    token = f"[{TOKEN_CLASS}]+"
    cut = "text"
    for p in (assign, ACCESS, HEX):
        cut = f"regexp_replace({cut}, '{p}', ' ', 'g')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{_sql_spans("assign", assign, f"regexp_extract_all(text, '{assign}', 1)")},
{_sql_spans("access", ACCESS, f"regexp_extract_all(text, '{ACCESS}')")},
{_sql_spans("hex", HEX, f"regexp_extract_all(text, '{HEX}')")},
base AS (SELECT doc_id, 0 AS k, a, b, v FROM assign WHERE len(v) >= {LEAST_VALUE} UNION ALL SELECT doc_id, 1, a, b, v FROM access UNION ALL SELECT doc_id, 2, a, b, v FROM hex),
sample AS (SELECT v, true AS r FROM base WHERE regexp_matches(v, '[0-9]') UNION ALL
  SELECT v, false FROM (SELECT unnest(regexp_extract_all({cut}, '{token}')) AS v FROM d) WHERE len(v) >= {LEAST_SAMPLE}),
counted AS (SELECT p, count(*) FILTER (WHERE r) AS r, count(*) FILTER (WHERE NOT r) AS o FROM (SELECT r, unnest({pair}) AS p FROM sample) GROUP BY p),
model AS (SELECT p, {ratio} AS ratio FROM (SELECT g.p, coalesce(r, 0) AS r, coalesce(o, 0) AS o
  FROM (SELECT unnest(generate_series(0, {SYMBOLS * SYMBOLS - 1})) AS p) g LEFT JOIN counted USING (p)) WINDOW w AS (PARTITION BY p // {SYMBOLS})),
{_sql_spans("tok", token, f"regexp_extract_all(text, '{token}')")},
cand AS (SELECT doc_id, a, b, v FROM tok WHERE len(v) >= {LEAST_TOKEN} AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
  AND (SELECT count(DISTINCT r) FROM sample) = 2
  AND NOT EXISTS (SELECT 1 FROM base WHERE base.doc_id = tok.doc_id AND base.a < tok.b AND tok.a < base.b)),
judged AS (SELECT c.doc_id, c.a, c.b FROM (SELECT doc_id, a, b, v, unnest({pair}) AS p FROM cand) c JOIN model USING (p)
  GROUP BY c.doc_id, c.a, c.b, c.v HAVING sum(ratio) > {int(MARGIN * 1e6)} * (len(c.v) - 1)),
spans AS (SELECT doc_id, k, a, b FROM base UNION ALL SELECT doc_id, 3, a, b FROM judged),
named AS (SELECT *, {KINDS}[k + 1] || ':' || a::BIGINT || ':' || b::BIGINT AS s FROM spans),
per AS (SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE k = {n}) AS n_{k}" for n, k in enumerate(KINDS))},
  string_agg(s, ',' ORDER BY a, k, b) FILTER (WHERE k < 3) AS base, string_agg(s, ',' ORDER BY a, k, b) AS spans FROM named GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)
"""
