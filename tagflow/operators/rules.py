"""Rules: derivation from nested documents, predicates and matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.sources.scratch import written

SCHEMA = "bucket string, config_id string, rule_id string, tag_filter map<string,string>, destination_arn string, key_prefix string"
_PAIR = "struct<Key:string,Value:string>"
DOCUMENT = f"Rules array<struct<ID:string,Status:string,Filter:struct<Tag:{_PAIR},Prefix:string,And:struct<Prefix:string,Tags:array<{_PAIR}>,Tag:{_PAIR}>>,Destination:struct<Bucket:string>>>"
#: Rules up to this number are broadcast; above it the tags are joined.
BROADCAST_RULES = 1_000
#: Rules that one literal condition may hold.
PREDICATE_RULES = 1_000
#: Lengths of prefixes that are indexed in a bucket; a longer prefix is found by the longest of them that it has.
LENGTHS = 16
#: Longest prefix that is indexed (rules with longer ones are found by other terms).
LONGEST = 1024
#: Operations with one term that one task reads, and terms that may have more of them than that.
SALT_ROWS, HEAVY_TERMS = 1 << 20, 10_000
TERM = ["bucket", "kind", "k", "v"]
#: What decides whether a rule matches, and how many rules with the same condition one row of `together` has.
CONDITION = ["bucket", "key_prefix", "tag_filter"]
MEMBERS = 1000
#: Bits of the map that tells which terms may be asked for.
BITS = 1 << 25
#: Matches of one condition from which on its operations are dealt to tasks, or crossed with its rules; at most CROSSED conditions are crossed.
PAIRS, CROSSED = 10_000_000, 128
#: Operations and rules of a crossed condition that one task gets; Spark's product holds up to 4096 rows of its right side as they are.
CROSSED_OPS, CROSSED_RULES = 1 << 14, 3000


def derive(documents: DataFrame, enabled_only: bool = False) -> DataFrame:
    """Rules with tags, from documents (bucket, config_id, Rules): the filter may be a tag, or `And` of tags and a prefix."""
    r = documents.select("bucket", "config_id", F.explode("Rules").alias("r"))
    r = r.where(F.col("r.Status") == "Enabled") if enabled_only else r
    f = F.col("r.Filter")
    many = F.concat(F.coalesce(f["And"]["Tags"], F.array()), F.filter(F.array(f["And"]["Tag"], f["Tag"]), lambda x: x.isNotNull()))
    # of a key that is there twice the last holds
    last = F.filter(many, lambda t, i: ~F.exists(F.slice(many, i + 2, F.size(many)), lambda u: u["Key"] == t["Key"]))
    prefix = F.coalesce(f["And"]["Prefix"], f["Prefix"])
    out = r.select("bucket", "config_id", F.coalesce("r.ID", F.lit("")).alias("rule_id"), F.map_from_entries(last).alias("tag_filter"), F.col("r.Destination.Bucket").alias("destination_arn"), F.when(prefix != "", prefix).alias("key_prefix"))
    return out.where(F.size("tag_filter") > 0)


def inline_rules(spark: SparkSession) -> DataFrame:
    """The fixed rules of the query catalogue."""
    arn = "arn:aws:s3:::copy-"
    rows = [
        ("lake-0", "c0", "r1", {"type": "click"}, arn + "a", "u/1"),
        ("lake-1", "c1", "r2", {"type": "view"}, arn + "b", None),
        ("lake-2", "c2", "r3", {"type": "purchase", "k": "7"}, arn + "c", None),
        ("lake-0", "c0", "r4", {"type": "click"}, arn + "d", None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def predicate(rules: list[dict]) -> Column:
    """One condition for all rules of a bucket: no rules is false, a rule without conditions is true."""
    one = [reduce(lambda a, b: a & b, [F.col("object_tags")[k].eqNullSafe(v) for k, v in r["tag_filter"].items()] + ([F.col("key").startswith(r["key_prefix"])] if r["key_prefix"] else []), F.lit(True)) for r in rules]
    return reduce(lambda a, b: a | b, one, F.lit(False))


def predicate_of(rules: DataFrame) -> Column:
    """`predicate` of a table of rules; more than PREDICATE_RULES are an error (`match` has no such bound)."""
    found = rules.limit(PREDICATE_RULES + 1).collect()
    if len(found) > PREDICATE_RULES:
        raise ValueError(f"more than {PREDICATE_RULES} rules for one condition: join them with match()")
    return predicate([r.asDict() for r in found])


def _small(rules: DataFrame) -> bool:
    return rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES


def _holds() -> Column:
    """The operation has the rule's tags (a missing tag is a null one) and its key the rule's prefix; unknown tags (null) match nothing."""
    tags = F.forall(F.map_entries("tag_filter"), lambda e: F.element_at("object_tags", e["key"]).eqNullSafe(e["value"]))
    return F.col("object_tags").isNotNull() & tags & (F.col("key_prefix").isNull() | F.startswith(F.col("key"), F.col("key_prefix")))


def match(ops: DataFrame, rules: DataFrame) -> DataFrame:
    """Operations with every rule of their bucket whose tags they hold and whose prefix their key has.

    A rule that is listed twice matches twice, one without tags whatever has its prefix. Few rules are
    broadcast, many are joined by their rarest term; both give the same rows.
    """
    if not _small(rules):
        return match_by_index(ops, rules)
    r = rules.withColumnRenamed("bucket", "rule_bucket")
    return ops.join(F.broadcast(r), (ops["bucket"] == r["rule_bucket"]) & _holds()).drop("rule_bucket")


def match_by_tags(ops: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by relational division, for any number of rules: join single tags, keep rules met in full.

    Every row of `rules` has a number of its own, so rules without an id are not taken for each other. Rules
    without a tag of a certain value are joined by their bucket.
    """
    numbered = rules.withColumnRenamed("bucket", "rule_bucket").withColumn("rule_no", F.monotonically_increasing_id())
    certain = F.map_filter("tag_filter", lambda _, v: v.isNotNull())
    kept = ["rule_no", *(c for c in numbered.columns if c != "rule_no")]
    tags = numbered.select(*kept, F.size(certain).alias("needed"), F.explode(certain).alias("tk", "tv"))
    held = ops.groupBy("lid").agg(*(F.first(c).alias(c) for c in ("bucket", "key", "object_tags")))
    held = held.select("lid", "bucket", "key", F.explode("object_tags").alias("k", "v"))
    pairs = held.join(tags, (held["bucket"] == tags["rule_bucket"]) & (held["k"] == tags["tk"]) & (held["v"] == tags["tv"]))
    pairs = pairs.where(F.col("key_prefix").isNull() | F.startswith(F.col("key"), F.col("key_prefix")))
    rule = F.struct(*(F.col(c) for c in rules.columns if c != "bucket"))
    met = pairs.groupBy("lid", "rule_no").agg(F.count("*").alias("n"), F.first("needed").alias("needed"), F.first(rule).alias("rule")).where("n = needed").select("lid", "rule.*")
    loose = numbered.where(F.size(certain) == 0).drop("rule_no")
    out = ops.join(met, "lid").where(_holds()).select(*ops.columns, *(c for c in rules.columns if c != "bucket"))
    other = ops.join(loose, (ops["bucket"] == loose["rule_bucket"]) & _holds()).select(*out.columns)
    return out.unionByName(other)


def _terms(tags: Column, prefixes: Column) -> Column:
    """Terms (kind, k, v): single tags, beginnings of the key, and the one that all of a bucket have."""
    term = lambda kind, k, v: F.struct(F.lit(kind).alias("kind"), k.alias("k"), v.alias("v"))
    tagged = F.transform(F.map_entries(F.map_filter(tags, lambda _, v: v.isNotNull())), lambda e: term("tag", e["key"], e["value"]))
    begun = F.transform(prefixes, lambda p: term("prefix", F.lit(""), p))
    none = F.slice(F.array(term("any", F.lit(""), F.lit(""))), 1, 0)
    return F.concat(F.coalesce(tagged, none), F.coalesce(begun, none), F.array(term("any", F.lit(""), F.lit(""))))


def _indexed(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct rules with `entries`, `copies` and `term` (a row for each term), and the prefix lengths of their buckets."""
    # equal rules are one row with a number of copies: numbers given to rows would not survive a task that is run again
    plain = [c for c in rules.columns if c != "tag_filter"]
    distinct = rules.withColumn("entries", F.array_sort(F.map_entries("tag_filter"))).groupBy(*plain, "entries").agg(F.count("*").alias("copies"))
    size = F.length("key_prefix")
    sizes = rules.where((size > 0) & (size <= LONGEST)).groupBy(F.col("bucket").alias("lb")).agg(F.array_sort(F.collect_set(size)).alias("all"))
    step = F.ceil(F.size("all") / LENGTHS)
    lengths = sizes.select("lb", F.filter("all", lambda _, i: i % step == 0).alias("lengths"))
    known = F.array_max(F.filter("lengths", lambda n: n <= size))
    begun = F.when(known.isNotNull(), F.array(F.substring(F.col("key_prefix"), F.lit(1), known)))
    # at most LENGTHS numbers for each bucket with rules
    rows = distinct.join(F.broadcast(lengths), distinct["bucket"] == lengths["lb"], "left").drop("lb").withColumn("tag_filter", F.map_from_entries("entries"))
    return rows.select(*rules.columns, "entries", "copies", F.explode(_terms(F.col("tag_filter"), begun)).alias("term")).drop("lengths"), lengths


def _terms_of(ops: DataFrame, lengths: DataFrame, *kept: str) -> DataFrame:
    """Operations beside each of their terms, as `_terms` makes them for rules; three scans, where an array of all terms would be made row by row without compiled code."""
    term = lambda kind, k, v: (F.lit(kind).alias("__kind"), k.alias("__k"), v.alias("__v"))
    tags = ops.select(*kept, F.explode("object_tags").alias("__tag", "__value")).where(F.col("__value").isNotNull())
    begun = ops.join(F.broadcast(lengths), ops["bucket"] == lengths["lb"]).select(*kept, F.col("key").alias("__key"), F.explode("lengths").alias("__n")).where(F.col("__n") <= F.length("__key"))
    prefixes = begun.select(*kept, *term("prefix", F.lit(""), F.substring(F.col("__key"), F.lit(1), F.col("__n"))))
    return tags.select(*kept, *term("tag", F.col("__tag"), F.col("__value"))).union(prefixes).union(ops.select(*kept, *term("any", F.lit(""), F.lit(""))))


def _perhaps(rows: DataFrame, named: list[str], wanted: DataFrame, asked: list[Column]) -> DataFrame:
    """Rows whose columns `named` may be equal to `asked` of some row of `wanted`: a map of BITS bits decides, and a full one lets more through."""
    place = lambda columns: F.pmod(F.xxhash64(*columns), F.lit(BITS))
    bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), (F.col(p) % 64).cast("int"))
    # at most BITS / 64 rows, however many are wanted
    words = wanted.select(place(asked).alias("__at")).groupBy(F.shiftright("__at", 6).alias("__word")).agg(F.bit_or(bit("__at")).alias("__bits"))
    placed = rows.withColumn("__place", place(named))
    hit = placed.join(F.broadcast(words), F.shiftright("__place", 6) == F.col("__word"))
    return hit.where(F.col("__bits").bitwiseAND(bit("__place")) != 0).drop("__place", "__word", "__bits")


def candidates(ops: DataFrame, rules: DataFrame) -> DataFrame:
    """Operations beside the rules whose rarest term they hold: every match is there once, for each copy of its rule.

    A rule's terms are its tags, its prefix (cut to an indexed length) and its bucket; the rarest is that which the fewest operations hold, and
    a rule with a term that no operation holds has no row. A term held by very many is dealt to salts.
    """
    indexed, lengths = _indexed(rules)
    flat = written(indexed.select("*", *(F.col(f"term.{c}").alias(c) for c in TERM[1:])).drop("term"))
    named = ["bucket", *(f"__{c}" for c in TERM[1:])]
    held = _perhaps(_terms_of(ops, lengths, "bucket"), named, flat, [F.col(c) for c in TERM])
    # terms that no rule has may be counted too
    counts = written(held.groupBy(F.col("bucket").alias("cb"), *(F.col(f"__{c}").alias(f"c{c}") for c in TERM[1:])).agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0  # one number
    plain = [c for c in rules.columns if c != "tag_filter"]
    counted = flat.join(counts, [flat["bucket"] == counts["cb"], *(flat[c] == counts[f"c{c}"] for c in TERM[1:])], "left")
    n = F.coalesce("n", F.lit(0))
    rarest = F.min(F.struct(n.alias("n"), *TERM[1:]))
    anchored = written(counted.groupBy(*plain, "entries", "copies").agg(rarest.alias("anchor")).where("anchor.n > 0"))
    # the terms with more than a share of all counted are at most HEAVY_TERMS
    heavy = counts.where(F.col("n") > max(SALT_ROWS, total // HEAVY_TERMS)).withColumn("salts", F.ceil(F.col("n") / SALT_ROWS).cast("int")).drop("n")
    salts = F.coalesce("salts", F.lit(1))

    def salted(rows: DataFrame, bucket: str, at: dict[str, Column]) -> DataFrame:
        return rows.join(F.broadcast(heavy), [F.col(bucket) == F.col("cb"), *(at[c] == F.col(f"c{c}") for c in TERM[1:])], "left").drop("cb", *(f"c{c}" for c in TERM[1:]))

    side = salted(anchored, "bucket", {c: F.col(f"anchor.{c}") for c in TERM[1:]})
    rule = F.struct(*(F.map_from_entries("entries").alias(c) if c == "tag_filter" else F.col(c) for c in rules.columns if c != "bucket"))
    side = side.select(F.col("bucket").alias("rule_bucket"), *(F.col(f"anchor.{c}").alias(f"r{c}") for c in TERM[1:]), rule.alias("rule"), "copies", F.explode(F.sequence(F.lit(0), salts - 1)).alias("rule_salt"))
    # operations stand only beside terms by which rules are met
    met = _perhaps(_terms_of(ops, lengths, *ops.columns), named, anchored, [F.col("bucket"), *(F.col(f"anchor.{c}") for c in TERM[1:])])
    terms = salted(met, "bucket", {c: F.col(f"__{c}") for c in TERM[1:]})
    terms = terms.withColumn("__salt", F.pmod(F.xxhash64("lid", "key"), salts).cast("int")).drop("salts")
    on = [F.col("bucket") == F.col("rule_bucket"), F.col("__salt") == F.col("rule_salt"), *(F.col(f"__{c}") == F.col(f"r{c}") for c in TERM[1:])]
    return terms.join(side, on).select(*ops.columns, "rule.*", "copies")


def together(rules: DataFrame) -> DataFrame:
    """Conditions (bucket, key_prefix, tag_filter), each once for all rules that have it: their other columns are in `members`, at most about MEMBERS of them in a row.

    A rule that is listed several times is with others that are listed as many `times`.
    """
    who = [c for c in rules.columns if c not in CONDITION]
    named = rules.withColumn("entries", F.array_sort(F.map_entries("tag_filter"))).drop("tag_filter")
    each = named.groupBy("bucket", "key_prefix", "entries", *who).agg(F.count("*").alias("times"))
    # at most a MEMBERS-th as many as rules
    large = each.groupBy(F.col("bucket").alias("lb"), F.col("key_prefix").alias("lp"), F.col("entries").alias("le")).agg(F.count("*").alias("n")).where(F.col("n") > MEMBERS)
    same = [F.col(c).eqNullSafe(F.col(d)) for c, d in (("bucket", "lb"), ("key_prefix", "lp"), ("entries", "le"))]
    dealt = each.join(large, same, "left").withColumn("chunk", F.coalesce(F.pmod(F.xxhash64(*who), F.ceil(F.col("n") / MEMBERS)), F.lit(0)))
    grouped = dealt.groupBy("bucket", "key_prefix", "entries", "times", "chunk").agg(F.collect_list(F.struct(*who)).alias("members"))
    return grouped.select("bucket", "key_prefix", F.map_from_entries("entries").alias("tag_filter"), "times", "members")


def match_by_index(ops: DataFrame, rules: DataFrame) -> DataFrame:
    """The same rows as `match` for any number of rules: each condition is tested once, and only where its rarest term is held; then come its rules."""
    ops, parts = written(ops), written(together(written(rules)))
    entries = F.array_sort(F.map_entries("tag_filter"))
    numbered = parts.groupBy("bucket", "key_prefix", entries.alias("entries")).agg(F.sum(F.size("members") * F.col("times")).alias("size"))
    # numbers given to rows are written: those of a task that is run again may differ
    conditions = written(numbered.select("bucket", "key_prefix", F.map_from_entries("entries").alias("tag_filter"), "size", F.monotonically_increasing_id().alias("cid")))
    met = written(candidates(ops, conditions).where(_holds()).select(*ops.columns, "cid", "size"))
    c = conditions.select("cid", F.col("bucket").alias("cb"), F.col("key_prefix").alias("cp"), F.array_sort(F.map_entries("tag_filter")).alias("ce"))
    same = [a.eqNullSafe(F.col(b)) for a, b in ((F.col("bucket"), "cb"), (F.col("key_prefix"), "cp"), (entries, "ce"))]
    return _with_rules(met, parts.join(c, same).drop("bucket", "cb", "cp", "ce"), ops.columns, [c for c in rules.columns if c != "bucket"])


def _with_rules(met: DataFrame, parts: DataFrame, ops: list[str], rules: list[str]) -> DataFrame:
    """Operations (`met`, with the number `cid` of a condition that they hold and its number of rules) beside each rule of the condition.

    The result grows with operations times rules. Conditions with the most matches are crossed, each in a branch of its own: Spark's product of two
    tables puts rows together in one buffer, where unfolding copies every row. All others are unfolded; operations of one with many matches are dealt to salts.
    """
    n, size = F.count("*"), F.first("size")
    work = written(met.groupBy("cid").agg(n.alias("n"), size.alias("size"), (n * size).alias("pairs")))
    total = work.agg(F.sum("pairs")).first()[0] or 0  # one number
    # at most HEAVY_TERMS
    large = work.where(F.col("pairs") > max(PAIRS, total // HEAVY_TERMS)).withColumn("salts", F.ceil(F.col("pairs") / PAIRS).cast("int"))
    found = large.orderBy(F.desc("pairs"), "cid").limit(CROSSED).collect()
    crossed = [r.cid for r in found]
    is_crossed = F.col("cid").isin(crossed)
    # partitions by the rows that come out: those that go in are few
    tasks = min(1 + (total - sum(r.pairs for r in found)) * 10 // PAIRS, HEAVY_TERMS)
    dealt = lambda rows: rows.join(F.broadcast(large.select("cid", "salts")), "cid", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    one = dealt(met.where(~is_crossed).drop("size")).withColumn("__salt", F.pmod(F.xxhash64("lid", "key"), F.col("salts")).cast("int")).drop("salts")
    side = dealt(parts.where(~is_crossed)).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    field = lambda c: F.col(c if c in CONDITION else f"__rule.{c}").alias(c)

    def each(rows: DataFrame, *kept: str) -> DataFrame:
        again = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
        return again.select(*kept, *(c for c in rules if c in CONDITION), F.explode("members").alias("__rule")).select(*kept, *map(field, rules))

    out = each(one.repartition(tasks, "cid", "__salt").join(side.repartition(tasks, "cid", "__salt"), ["cid", "__salt"]), *ops)
    if crossed:
        counted = large.where(is_crossed)
        slots = counted.agg(F.sum(F.ceil(F.col("n") / CROSSED_OPS) + F.ceil(F.col("size") / CROSSED_RULES))).first()[0]  # one number

        def cut(rows: DataFrame, by: list[str], count: str, most: int) -> DataFrame:
            sized = rows.where(is_crossed).join(F.broadcast(counted.select(F.col("cid").alias("lc"), F.ceil(F.col(count) / most).alias("__cuts"))), F.col("cid") == F.col("lc"))
            put = sized.withColumn("__cut", F.pmod(F.xxhash64(*by), F.col("__cuts"))).repartition(2 * slots, "cid", "__cut")
            return written(put.drop("lc", "__cuts", "__cut"), by="cid")

        left = cut(met.drop("size"), ["lid", "key"], "n", CROSSED_OPS)
        right = cut(each(parts.where(is_crossed), "cid"), [c for c in rules if c not in CONDITION], "size", CROSSED_RULES)
        for cid in crossed:
            mine = [rows.where(F.col("cid") == cid).drop("cid") for rows in (left, right)]
            out = out.union(mine[0].crossJoin(mine[1].hint("shuffle_replicate_nl")).select(*ops, *rules))
    return out


def errors(ops: DataFrame) -> DataFrame:
    """Operations whose tags are not known (null), with the reason: they match nothing and stop nothing; no tags at all is no error."""
    return ops.where(F.col("object_tags").isNull()).select("bucket", "key", F.lit("indeterminate tags").alias("reason"))


def skip_reports(buckets: DataFrame, documents: DataFrame, rules: DataFrame) -> DataFrame:
    """Buckets (bucket) that give no rules, with the reason.

    `documents` has bucket, and `error` (null: the document was read) as the source reported it.
    """
    d = documents.groupBy(F.col("bucket").alias("db")).agg(F.max("error").alias("error"), F.count("*").alias("found"))
    have = rules.select(F.col("bucket").alias("rb")).distinct()
    left = buckets.select("bucket").join(d, F.col("bucket") == F.col("db"), "left").join(have, F.col("bucket") == F.col("rb"), "left_anti")
    reason = F.when(F.col("found").isNull() | (F.col("error") == "absent"), "no configuration").when(F.col("error") == "denied", "no permission to read the configuration").when(F.col("error").isNotNull(), "unreadable configuration").otherwise("no rule with tags")
    return left.select("bucket", reason.alias("reason"))


def grouped(matches: DataFrame) -> DataFrame:
    """Per operation and config: the sorted rule ids and destinations (an empty one adds nothing)."""
    arn = F.when(F.col("destination_arn") != "", F.col("destination_arn"))
    return matches.groupBy("lid", "bucket", "key", "config_id").agg(F.array_sort(F.collect_set("rule_id")).alias("rules"), F.array_sort(F.collect_set(arn)).alias("destinations"))
