"""Personal data by patterns, and by contexts that are learned from them.

Base patterns find seed entities. Words around the seeds, and around other tokens that hold
digits or an at sign, are lexical patterns; patterns and instances form a graph. A pattern
scores by its instances that are known for a kind, against those known for others and those
without the kind's shape: what has the shape and is not known yet speaks for neither. An
instance scores by its best patterns, in turn. Tokens of a kind's shape that stand in a
pattern of high confidence are new identifiers. Secrets have no base pattern: their seeds are
long hexadecimal tokens, and only contexts make spans of them. All of it is SQL over columns:
no row leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.text import WORD, let, running_sum, text_key, whole_text
from linkrank.plans.workspace import Workspace

# The kinds in their order, and what matches of each look like. Possessive
# quantifiers and the looks behind only spare the matcher work: a match starts where a run
# of its characters starts, or where the match before it ended.
KINDS = ("email", "ip", "card", "phone")
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
# Kinds that contexts discover, and what a token must look like to be a seed of the one that
# has no base pattern.
SECRET = "secret"
DISCOVERED = (*KINDS, SECRET)
MIXED = r"(?=[^0-9]*+[0-9])(?=[^A-Za-z]*+[A-Za-z])"
SECRET_SEED = rf"^{MIXED}[0-9A-Fa-f]{{32,}}+$"

# Any token that could be an identifier: it holds a digit or an at sign.
TOKEN = r"(?<![A-Za-z0-9._%+:/#=-])[A-Za-z._%+:/#=-]*+[0-9@][A-Za-z0-9._%+:/#=@-]*+"
# Characters on either side of a token that its context is taken from.
CONTEXT = 64
# What a token must look like to be a new identifier of a kind. Anchored and possessive: a
# token of any length is read once.
SHAPES = {
    "email": r"^[^A-Za-z0-9]*+[A-Za-z0-9][^@]*+@[^A-Za-z0-9]*+[A-Za-z0-9]",
    "ip": r"^[0-9A-Fa-f]++(?:[.:][0-9A-Fa-f]*+){2,}+$",
    "card": r"^(?:[^0-9]*+[0-9]){12,19}+[^0-9]*+$",
    "phone": r"^(?:[^0-9]*+[0-9]){7,15}+[^0-9]*+$",
    SECRET: rf"^{MIXED}[A-Za-z0-9+/=_-]{{16,}}+$",
}
# Marks at the left of a token that are no part of it, and at its right.
LEFT_MARKS, RIGHT_MARKS = "._%+:/#=-", "._%+:/#=@-"


@dataclass(frozen=True)
class Bootstrap:
    """Rounds of scoring; the share of known instances among those that can be judged, and the
    different known ones, that make a pattern trustworthy; how sure an instance must be to
    count as known."""

    rounds: int = 3
    confidence: float = 0.9
    support: int = 5
    known: float = 0.8


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    """Whether a match's digits pass the Luhn check: every second one from the right counts
    double, its digits added."""

    def value(digit: Column, i: Column) -> Column:
        d = F.ascii(digit) - 48
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    digits = F.split(F.reverse(_digits(match)), "")
    total = F.aggregate(
        F.transform(F.filter(digits, lambda x: x != ""), value), F.lit(0), lambda a, x: a + x
    )
    return total % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """Whether a match of the kind's pattern is one."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":

        def small(part: Column) -> Column:
            bare = F.regexp_replace(part, "^0+", "")
            return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

        return F.forall(F.split(match, r"\."), small)
    count = F.length(_digits(match))
    if kind == "card":
        return F.when(count.between(16, 19), _luhn(match)).otherwise(False)
    return count.between(8, 15)


def matches(text: Column, pattern: str) -> Column:
    """All matches in order: ``array<struct<start, end, text, before, after>>`` in code
    points, with the text between a match and its neighbours, cut to CONTEXT characters.

    The parts between matches and the matches themselves make up the text, so their lengths
    add up to the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def placed(pair: Column) -> Column:
        parts, gaps = pair["parts"], pair["gaps"]
        lengths = F.transform(
            parts, lambda m, i: (F.length(m) + F.length(gaps[i])).cast("long")
        )

        def rows(before: Column) -> Column:
            def row(m: Column, i: Column) -> Column:
                start = before[i] + F.length(gaps[i])
                return F.struct(
                    start.alias("start"),
                    (start + F.length(m)).alias("end"),
                    m.alias("text"),
                    F.substring(gaps[i], -CONTEXT, CONTEXT).alias("before"),
                    F.substring(gaps[i + 1], 1, CONTEXT).alias("after"),
                )

            return F.transform(parts, row)

        return let(running_sum(lengths), rows)

    pair = F.struct(found.alias("parts"), between.alias("gaps"))
    return let(pair, placed)


def base_spans(text: Column) -> Column:
    """Valid matches of every kind: ``array<struct<kind, start, end>>``, in order."""

    def of(kind: str) -> Column:
        def kept(found: Column) -> Column:
            ok = F.filter(found, lambda m: valid(kind, m["text"]))
            return F.transform(
                ok, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"], m["end"])
            )

        return let(matches(text, PATTERNS[kind]), kept)

    none = F.lit([]).cast("array<struct<kind:string,start:bigint,end:bigint>>")
    numbers = F.concat(*[of(k) for k in ("ip", "card", "phone")])
    # Every other kind needs a digit, an email an at sign.
    return F.concat(
        F.when(F.contains(text, F.lit("@")), of("email")).otherwise(none),
        F.when(text.rlike("[0-9]"), numbers).otherwise(none),
    ).cast("array<struct<kind:string,start:bigint,end:bigint>>")


def occurrences(text: Column) -> Column:
    """Base matches and identifier-like tokens, with their contexts."""
    # Behind a match of another kind no email may start inside a run of its characters: the
    # run would be read to its end once for every such match.
    apart = EMAIL.replace(r"\G|", "")
    # Digits inside a word are no number of their own.
    number = rf"(?<![A-Za-z0-9]){CARD}(?![A-Za-z0-9])"
    either = "|".join(f"(?:{p})" for p in (apart, PHONE, IP, number, TOKEN))
    kind = "array<struct<start:bigint,end:bigint,text:string,before:string,after:string>>"
    return F.when(text.rlike("[0-9@]"), matches(text, either).cast(kind)).otherwise(
        F.lit([]).cast(kind)
    )


def _instances(found: DataFrame) -> DataFrame:
    """``(doc_id, key, start, end, instance, kind, patterns)``: one row per occurrence.

    ``kind`` is that of a base match or of a secret's seed, null for others; patterns are the
    word before, the two words before, and the words on both sides.
    """
    one = found.select("doc_id", "key", F.explode("found").alias("o")).select("doc_id", "key", "o.*")
    # Marks at a token's edges do not belong to it.
    tail = F.ltrim(F.col("text"), F.lit(LEFT_MARKS))
    head = F.length("text") - F.length(tail)
    bare = F.rtrim(tail, F.lit(RIGHT_MARKS))
    kind = F.when(bare.rlike(SECRET_SEED), F.lit(SECRET))
    for name in reversed(KINDS):
        kind = F.when(F.col("text").rlike(f"^(?:{PATTERNS[name]})$") & valid(name, F.col("text")), name).otherwise(kind)
    left = F.regexp_extract_all(F.lower("before"), F.lit(WORD), F.lit(0))
    right = F.regexp_extract_all(F.lower("after"), F.lit(WORD), F.lit(0))
    words = one.select(
        "doc_id", "key", "start", "end", "text", "before", "after",
        kind.alias("kind"), head.alias("head"), bare.alias("bare"), left.alias("l"), right.alias("r"),
    )
    last, first = F.try_element_at("l", F.lit(-1)), F.try_element_at("r", F.lit(1))
    patterns = F.array_compact(
        F.array(
            F.concat(F.lit("<"), last),
            F.concat(F.lit("<<"), F.try_element_at("l", F.lit(-2)), F.lit(" "), last),
            F.concat(F.lit("<>"), last, F.lit(" "), first),
        )
    )
    base = F.coalesce(F.col("kind") != SECRET, F.lit(False))
    start = F.when(base, F.col("start")).otherwise(F.col("start") + F.col("head"))
    return words.where(base | (F.length("bare") > 0)).select(
        "doc_id",
        "key",
        start.alias("start"),
        F.when(base, F.col("end")).otherwise(start + F.length("bare")).alias("end"),
        F.lower(F.when(base, F.col("text")).otherwise(F.col("bare"))).alias("instance"),
        "kind",
        patterns.alias("patterns"),
    )


def _fits(instance: Column) -> Column:
    """Kinds whose shape a token has."""
    return F.array_compact(
        F.array(*[F.when(instance.rlike(SHAPES[k]), F.lit(k)) for k in DISCOVERED])
    )


def trusted_patterns(ws: Workspace, instances: DataFrame, how: Bootstrap) -> DataFrame:
    """``(pattern, kind)`` of high confidence, by rounds over the pattern-instance graph."""
    edges = ws.save(
        instances.select("instance", "kind", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "instance", "kind")
        .agg(F.count("*").alias("n")),
        "edges",
    )
    seeds = edges.where("kind IS NOT NULL").select("instance", "kind").distinct()
    known = ws.save(seeds.select("instance", "kind", F.lit(1.0).alias("sure")), "known")
    seeds = known
    flat = edges.groupBy("pattern", "instance").agg(F.sum("n").alias("n"))
    flat = ws.save(flat.withColumn("fits", _fits(F.col("instance"))), "graph")

    def fitting(kind: str) -> Column:
        return F.array_contains("fits", kind)

    unfit = [F.sum(F.when(~fitting(k), F.col("n")).otherwise(0)).alias(f"unfit_{k}") for k in DISCOVERED]
    unfit = ws.save(flat.groupBy("pattern").agg(*unfit), "unfit")
    for _ in range(how.rounds):
        kinds = F.map_from_entries(F.collect_list(F.struct("kind", "sure")))
        sums = []
        for k in DISCOVERED:
            sure = F.try_element_at("sures", F.lit(k))
            sums += [
                F.coalesce(F.sum(sure * F.col("n")), F.lit(0.0)).alias(f"hits_{k}"),
                F.count(sure).alias(f"support_{k}"),
                F.sum(F.when(fitting(k), F.col("n")).otherwise(0)).alias(f"known_{k}"),
            ]
        judged = [
            F.struct(
                F.lit(k).alias("kind"),
                F.col(f"support_{k}").alias("support"),
                F.try_divide(f"hits_{k}", F.col(f"unfit_{k}") + F.col(f"known_{k}")).alias("score"),
            )
            for k in DISCOVERED
        ]
        scored = (
            flat.join(known.groupBy("instance").agg(kinds.alias("sures")), "instance")
            .groupBy("pattern")
            .agg(*sums)
            .join(unfit, "pattern")
            .select("pattern", F.inline(F.array(*judged)))
            .where((F.col("score") >= how.confidence) & (F.col("support") >= how.support))
        )
        scored = ws.save(scored, "scored")
        reached = (
            flat.join(scored.select("pattern", "kind", "score"), "pattern")
            .where(F.array_contains("fits", F.col("kind")))
            .groupBy("instance", "kind")
            .agg(F.max("score").alias("sure"))
            .where(F.col("sure") >= how.known)
        )
        fresh = reached.join(seeds.select("instance"), "instance", "left_anti")
        known = ws.save(seeds.unionByName(fresh.select("instance", "kind", "sure")), "known")
    return scored.select("pattern", "kind")


def find_personal_data(
    ws: Workspace, docs: DataFrame, how: Bootstrap = Bootstrap()
) -> DataFrame:
    """``(doc_id, base, spans)``: ``array<struct<kind, start, end>>`` of every document.

    ``base`` are the patterns' valid matches, ``spans`` those and what contexts discover; a
    kind's spans never repeat. Null counts as empty: no spans. Repeated rows get the same.
    Extra columns are ignored.
    """
    text = whole_text()
    read = docs.select("doc_id", text_key().alias("key"), text.alias("body"))
    found = ws.save(
        read.select("doc_id", "key", base_spans(F.col("body")).alias("base"), occurrences(F.col("body")).alias("found")),
        "found",
    )
    instances = ws.save(_instances(found.where(F.size("found") > 0)), "instances")
    trusted = trusted_patterns(ws, instances, how)
    fresh = (
        instances.where(f"kind IS NULL OR kind = '{SECRET}'")
        .select("doc_id", "key", "start", "end", "instance", F.explode("patterns").alias("pattern"))
        .join(trusted, "pattern")
        .where(F.array_contains(_fits(F.col("instance")), F.col("kind")))
        .groupBy("doc_id", "key")
        .agg(F.collect_set(F.struct("kind", "start", "end")).alias("fresh"))
        .select(F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key"), "fresh")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("key") == F.col("_key"))
    fresh_or_none = F.coalesce(F.array_except("fresh", "base"), F.slice("base", 1, 0))
    return (
        found.select("doc_id", "key", "base")
        .join(fresh, same, "left")
        .select("doc_id", "base", F.concat("base", fresh_or_none).alias("spans"))
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, by kind as listed (secrets last), then start,
    comma-joined."""

    def ranked(s: Column) -> Column:
        rank = F.lit(0)
        for i, kind in enumerate(DISCOVERED):
            rank = F.when(s["kind"] == kind, i).otherwise(rank)
        return F.struct(rank.alias("rank"), s["start"], s["end"], s["kind"])

    ordered = F.array_sort(F.transform(spans, ranked))
    return F.array_join(
        F.transform(
            ordered,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def span_digest(found: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret)`` of found
    spans; the counts are those of the base spans, but for the secrets."""

    def count(kind: str, spans: str = "base") -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        count(SECRET, "spans").alias("n_secret"),
    )
