"""Personal data by patterns of form, and by bootstrapped patterns of context.

Everything here is DataFrame expressions; no Python runs on the executors.

1. Base spans: emails, IP addresses, card and phone numbers by regular expression.
2. Candidates: every white-space token with a digit or an ``@``, and every run of such
   tokens on one line, with its context (the two words before it; the word before and the
   word after it).
3. Bootstrapping: candidates inside base spans are seeds of their kind. Contexts
   (patterns) and candidate texts (instances) make a graph, counted over the whole
   corpus. Each round scores the patterns by the share of their distinct instances
   that are known to be of a kind (with a least support), and takes an instance as known
   if good patterns stand at half or more of its occurrences. Rounds go on until one finds nothing new.
4. Candidates outside base spans whose instance became known are added.

Secrets (a value assigned to a name like token or password) are found by their form too and
reported apart.

The regular expressions use possessive quantifiers and look-behinds that make each
run of characters be tried once; they match what the plain forms match, in linear
time and without deep recursion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import let, materialise, small_side

# The forms of the kinds, in the order of the output.
KINDS = ["email", "ip", "card", "phone"]
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_IP = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"
CANDIDATE = r"(?<![^\s])[^\s0-9@]*+[0-9@][^\s]*+"
#: Punctuation that is no part of a candidate at its ends.
EDGES = "\"'()[]{}<>.,;:!?"
# Runs of candidates on one line; brackets at their ends may belong to them.
RUN = CANDIDATE + r"(?:[\x20\t][^\s0-9@]*+[0-9@][^\s]*+)++"
RUN_EDGES = "\"'<>,.;:!?"
SECRET = r"(?i)(?:token|secret|passw(?:or)?d|api[_-]?key)\x20?[:=]\x20?[\"']?[A-Za-z0-9_+/=-]{16,}+"
#: Characters of context kept on either side.
CONTEXT = 64

LEAST_SUPPORT, LEAST_PRECISION = 5, 0.8


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, k: Column) -> Column:
        d = F.substring(digits, n - k, F.lit(1)).cast("int")
        return total + F.when(k % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(_IP)
    if kind == "email":
        return F.lit(True)
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)


def _starts(gaps: Column, matches: Column) -> Column:
    """Start of each match, from the lengths of the gaps before and the matches.

    Prefix sums in blocks, so that a text with very many matches stays near linear.
    """
    block = 256

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def sums(long: Column) -> Column:
        last = F.floor((F.size(long) - 1) / block).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: total(F.slice(long, b * block + 1, F.lit(block))))

    def starts(t: Column) -> Column:
        def start(gap: Column, i: Column) -> Column:
            b = F.floor(i / block).cast("int")
            return (total(F.slice(t["sums"], F.lit(1), b)) + total(F.slice(t["long"], b * block + 1, i % block)) + gap).cast("long")

        return F.transform(t["gaps"], start)

    gap_lengths = F.transform(F.slice(gaps, F.lit(1), F.size(matches)), lambda g: F.length(g))
    long = F.zip_with(gap_lengths, matches, lambda g, m: g + F.length(m))
    return let(F.struct(gap_lengths.alias("gaps"), long.alias("long")), lambda t: let(
        F.struct(t["gaps"].alias("gaps"), t["long"].alias("long"), sums(t["long"]).alias("sums")), starts))


def _with_matches(df: DataFrame, name: str, form: str, hint: Column) -> DataFrame:
    """Adds ``name``_m (matches), ``name``_g (gaps, one more), ``name``_s (starts)."""
    none = F.array().cast("array<string>")
    df = df.withColumn(f"{name}_m", F.when(hint, F.regexp_extract_all("_text", F.lit(form), F.lit(0))).otherwise(none))
    df = df.withColumn(f"{name}_g", F.when(F.size(f"{name}_m") > 0, F.split("_text", form, -1)).otherwise(none))
    return df.withColumn(f"{name}_s", F.when(F.size(f"{name}_m") > 0, _starts(F.col(f"{name}_g"), F.col(f"{name}_m"))).otherwise(F.array().cast("array<bigint>")))


def _spans(kind: str) -> Column:
    m, s = F.col(f"{kind}_m"), F.col(f"{kind}_s")
    all_ = F.zip_with(m, s, lambda x, a: F.struct(F.lit(kind).alias("kind"), a.alias("start"), (a + F.length(x)).alias("end"), x.alias("value"), _valid(kind, x).alias("ok")))
    return F.transform(F.filter(all_, lambda x: x["ok"]), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value")))


def _flat(text: Column) -> Column:
    return F.trim(F.lower(F.translate(text, "\t\n\x0b\x0c\r", "     ")))


def _candidates(name: str, edges: str, exact: bool) -> Column:
    """The matches ``name`` as (start, end, value, kind, patterns).

    ``kind`` is that of the base span that starts there (``exact``: that it is), NULL where it overlaps
    none. Matches that overlap base spans in another way are no candidates."""
    def candidate(t: Column, i: Column) -> Column:
        token, gap, after = F.get(t["m"], i), F.get(t["g"], i), F.get(t["g"], i + 1)
        lead = F.length(token) - F.length(F.ltrim(token, F.lit(edges)))
        value = F.trim(token, F.lit(edges))
        left, right = _flat(F.right(gap, F.lit(4 * CONTEXT))), _flat(F.left(after, F.lit(4 * CONTEXT)))
        start = F.get(t["s"], i) + lead
        parts = F.struct(token.alias("token"), value.alias("value"), start.alias("start"), (start + F.length(value)).alias("end"),
                         F.substring_index(left, " ", -2).alias("two"), F.substring_index(left, " ", -1).alias("one"), F.substring_index(right, " ", 1).alias("next"))
        return let(parts, lambda c: let(F.struct(c.alias("c"), F.get(F.filter(t["base"], lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"])), F.lit(0)).alias("span")), described))

    def described(x: Column) -> Column:
        c, span = x["c"], x["span"]
        fits = (span["start"] == c["start"]) & (span["end"] == c["end"]) if exact else (span["start"] >= c["start"]) & (span["start"] < c["end"])
        return F.struct(
            F.coalesce(span["start"], c["start"]).alias("start"), F.coalesce(span["end"], c["end"]).alias("end"),
            F.coalesce(span["value"], c["value"]).alias("value"), span["kind"].alias("kind"), (span.isNull() | fits).alias("fits"),
            F.filter(F.array(F.when(F.contains(c["two"], F.lit(" ")), F.concat(F.lit("2:"), F.right(c["two"], F.lit(CONTEXT)))),
                             F.when((c["one"] != "") & (c["next"] != ""), F.concat(F.lit("1:"), F.right(c["one"], F.lit(CONTEXT)), F.lit(" _ "), F.left(c["next"], F.lit(CONTEXT))))),
                     lambda p: p.isNotNull()).alias("patterns"))

    all_ = F.struct(F.col(f"{name}_m").alias("m"), F.col(f"{name}_g").alias("g"), F.col(f"{name}_s").alias("s"), F.col("base").alias("base"))
    found = F.when(F.size(f"{name}_m") > 0, let(all_, lambda t: F.transform(F.sequence(F.lit(0), F.size(t["m"]) - 1), lambda i: candidate(t, i))))
    return F.transform(F.filter(found, lambda c: c["fits"] & (F.length(c["value"]) >= 5)), lambda c: c.dropFields("fits"))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, key, base, n_secret, candidates`` of each row; ``key`` hashes id and text.

    ``base``: array of (kind, start, end), by kind and start. ``candidates``: array of
    (start, end, value, kind, patterns), tokens first, then runs of tokens.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "_text"))
    digit, at = F.col("_text").rlike("[0-9]"), F.contains(F.col("_text"), F.lit("@"))
    for kind, hint in (("email", at), ("ip", digit), ("card", digit), ("phone", F.contains(F.col("_text"), F.lit("+")))):
        rows = _with_matches(rows, kind, FORMS[kind], hint)
    rows = rows.withColumn("base", F.concat(*[_spans(k) for k in KINDS]))
    rows = _with_matches(rows, "token", CANDIDATE, digit | at)
    rows = _with_matches(rows, "run", RUN, F.size("token_m") > 1)
    none = F.expr("CAST(array() AS array<struct<start:bigint,end:bigint,value:string,kind:string,patterns:array<string>>>)")
    candidates = F.concat(F.coalesce(_candidates("token", EDGES, exact=False), none), F.coalesce(_candidates("run", RUN_EDGES, exact=True), none))
    secrets = F.when(F.col("_text").rlike("[:=]"), F.regexp_count("_text", F.lit(SECRET))).otherwise(0).cast("long")
    return rows.select("doc_id", "key", F.transform("base", lambda b: b.dropFields("value")).alias("base"), secrets.alias("n_secret"),
                       candidates.alias("candidates"))


def bootstrap(candidates: DataFrame, support: int = LEAST_SUPPORT, precision: float = LEAST_PRECISION) -> DataFrame:
    """``value, kind`` of the instances that context shows to be of a kind.

    ``candidates`` has ``value, kind, patterns``. A round: a pattern is good for a
    kind if at least ``support`` distinct known instances of it stand in it and
    they are at least the share ``precision`` of all its distinct instances; an
    unknown instance becomes known if at half or more of all its occurrences a good pattern stands, as
    the kind with the greatest sum, over those occurrences, of the log-weight of the best pattern.
    What is known stays known; ends when a round finds nothing new.
    """
    places = materialise(candidates.groupBy("value", F.array_distinct("patterns").alias("patterns"))
                         .agg(F.max("kind").alias("kind"), F.count(F.lit(1)).alias("times")), "places")
    edges = places.select("value", "kind", F.explode("patterns").alias("pattern")).groupBy("pattern", "value").agg(F.max("kind").alias("kind"))
    # Patterns with fewer distinct instances than ``support`` can never be good.
    size = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    edges = materialise(edges.join(size, "pattern"), "graph")
    unknown = materialise(places.where("kind IS NULL").select("value", "patterns", "times").withColumn("place", F.xxhash64("patterns")), "unknown")
    times = unknown.groupBy("value").agg(F.sum("times").alias("all_times"))
    known = materialise(unknown.select("value", F.lit(None).cast("string").alias("kind")).limit(0), "instances")
    while True:
        now = edges.join(known.withColumnRenamed("kind", "found"), "value", "left").withColumn("kind", F.coalesce("kind", "found"))
        good = now.where("kind IS NOT NULL").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("k"), F.first("n").alias("n")) \
            .where((F.col("k") >= support) & (F.col("k") >= precision * F.col("n"))) \
            .select("pattern", F.col("kind").alias("found"), (F.col("k") / F.col("n") * F.log2(F.col("k").cast("double"))).alias("weight"))
        good = materialise(good, "patterns")
        votes = unknown.join(known.select("value"), "value", "left_anti").select("value", "place", "times", F.explode("patterns").alias("pattern")) \
            .join(small_side(good, 200_000), "pattern") \
            .groupBy("value", "place", "times").agg(F.max(F.struct("weight", "found")).alias("best")) \
            .groupBy("value", "best.found").agg(F.sum(F.col("best.weight") * F.col("times")).alias("weight"), F.sum("times").alias("votes")) \
            .groupBy("value").agg(F.max(F.struct("weight", "found")).alias("best"), F.sum("votes").alias("votes"))
        new = materialise(votes.join(times, "value").where("2 * votes >= all_times").select("value", F.col("best.found").alias("kind")), "instances")
        if new.isEmpty():
            return known
        known = materialise(known.union(new), "instances")


def personal_data(docs: DataFrame, support: int = LEAST_SUPPORT, precision: float = LEAST_PRECISION) -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_secret, flagged``.

    The counts and ``base_sha256`` (of ``kind:start:end`` by kind and start, comma
    joined) are of the base spans; ``spans`` also holds the ``n_added`` spans that
    context adds (of overlapping ones the longest). ``n_secret`` counts assigned secrets; ``flagged``
    is true where there is any span or secret. Offsets are code points, the end exclusive.

    - NULL text is empty; an empty text has no spans (the hash of the empty string).
    - A NULL doc_id stays NULL; repeated rows are returned as often as they come.
    - Very long texts are scanned whole; the forms are tried once per run of characters. Of kinds
      with equal weight for an instance the last by name is taken.
    - An empty table gives an empty result; other columns are ignored.
    """
    rows = materialise(scan(docs), "scan")
    candidates = rows.select("key", F.explode("candidates").alias("c")).select("key", "c.*")
    known = bootstrap(candidates, support, precision)
    added = candidates.where("kind IS NULL").drop("kind").join(small_side(known, 200_000), "value") \
        .groupBy("key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    rows = rows.select("doc_id", "key", "base", "n_secret").join(added, "key", "left") \
        .withColumn("added", F.coalesce("added", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")))
    # A run of tokens takes the place of the tokens in it.
    longest = F.filter("added", lambda s: ~F.exists("added", lambda o: (o["start"] <= s["start"]) & (o["end"] >= s["end"]) & (o["end"] - o["start"] > s["end"] - s["start"])))
    rows = rows.withColumn("added", longest)

    def line(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(kind: str, spans: Column) -> Column:
        return F.filter(spans, lambda s: s["kind"] == kind)

    def in_order(kind: str) -> Column:
        places = F.transform(of_kind(kind, F.concat("base", "added")), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return F.transform(F.array_sort(places), lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    by_kind = F.concat(*[in_order(k) for k in KINDS])
    counts = [F.size(of_kind(k, F.col("base"))).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(line(F.col("base")), 256).alias("base_sha256"), line(by_kind).alias("spans"),
                       F.size("added").cast("long").alias("n_added"), "n_secret",
                       ((F.size("base") > 0) | (F.size("added") > 0) | (F.col("n_secret") > 0)).alias("flagged"))
