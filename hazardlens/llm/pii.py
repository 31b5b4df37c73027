"""Personal data: fixed patterns, and identifiers that bootstrapped contexts discover."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.llm.staging import staged

KINDS = ("email", "ip", "card", "phone", "id")
SPACE = r"\x20\x09-\x0D"
# the starts are such that no match can begin inside a run that was already tried
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
WORD = rf"[^{SPACE}]++"
BLANKS = "\x20\t\n\x0b\f\r"
# what stands before the first and after the last word; no word has a space
EDGE = " "
SPAN = "struct<start:int,kind:int,end:int,value:string>"
MARKS = 1 << 18


@dataclass(frozen=True)
class Bootstrap:
    """``support``: distinct instances a context must have; ``confidence``: the score that contexts
    and instances need; ``outside``: what a place of an instance outside trusted contexts counts
    against it; ``rounds``: how often new contexts are sought, by default until there are none;
    ``shortest``: characters an identifier has at least."""

    support: int = 3
    confidence: float = 0.6
    outside: float = 0.25
    rounds: int | None = None
    shortest: int = 4


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.reverse(number)
    places = F.sequence(F.lit(1), F.length(turned))

    def add(total: Column, i: Column) -> Column:
        d = F.substr(turned, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.when(F.length(number) > 0, F.aggregate(places, F.lit(0), add) % 10 == 0).otherwise(False)


def valid(kind: str, value: Column) -> Column:
    """The check that a match of the pattern must pass."""
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return ~F.exists(parts, lambda p: (F.length(p) > 3) | (F.coalesce(p.try_cast("int"), F.lit(0)) > 255))
    number = digits(value)
    if kind == "card":
        return F.when(F.length(number).between(14, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(number).between(10, 15)
    return F.lit(True)


def _pairs(text: Column, pattern: str) -> Column:
    """Each match with the text between it and the one before."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"))


def _has(text: Column, pattern: str, needs: str) -> Column:
    there = text.rlike(pattern)
    return (F.contains(text, F.lit(needs)) & there) if needs else there


def _spans_of(text: Column, kind: str) -> Column:
    """The valid matches of one kind; their places add up from gaps and matches."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["gap"])
        end = begin + F.coalesce(F.length(pair["match"]), F.lit(0))
        rank = F.lit(KINDS.index(kind)).alias("kind")
        span = F.struct(begin.alias("start"), rank, end.alias("end"), pair["match"].alias("value"))
        good = pair["match"].isNotNull() & valid(kind, pair["match"])
        out = F.when(good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    return F.aggregate(_pairs(text, PATTERNS[kind]), start, step, lambda acc: acc["out"])


def base_spans(text: Column) -> Column:
    """Spans of the four fixed kinds, sorted by start and kind.

    Starts and ends are code points from 0, the end exclusive. Matches are leftmost and
    do not overlap within a kind; one that fails its check is dropped and not retried.
    """
    none = F.array().cast(f"array<{SPAN}>")
    found = [
        F.when(_has(text, PATTERNS[kind], NEEDS[kind]), _spans_of(text, kind)).otherwise(none) for kind in KINDS[:4]
    ]
    return F.sort_array(F.concat(*found))


def _contexts() -> Column:
    """The words around a place, one to three on each side, as contexts; none of a text's edge alone."""
    l1, l2, l3, r1, r2, r3 = map(F.col, ("l1", "l2", "l3", "r1", "r2", "r3"))
    left, right, gap = F.lit("<"), F.lit(">"), F.lit(" ")
    # concat is null where a word is missing
    return F.array(
        F.when(l1 != EDGE, F.concat(left, l1)),
        F.concat(left, l2, gap, l1),
        F.concat(left, l3, gap, l2, gap, l1),
        F.when(r1 != EDGE, F.concat(right, r1)),
        F.concat(right, r1, gap, r2),
        F.concat(right, r1, gap, r2, gap, r3),
    )


def _slots(rows: DataFrame, text: str) -> DataFrame:
    """``_row``, place ``k`` among the words, ``word`` and its three neighbours on each side, in lower case."""
    words = F.split(F.btrim(F.lower(F.col(text)), F.lit(BLANKS)), rf"[{SPACE}]+")
    none = F.lit(None).cast("string")
    padded = F.concat(F.array(none, none, F.lit(EDGE)), words, F.array(F.lit(EDGE), none, none))
    texts = rows.where(F.col(text).rlike(rf"[^{SPACE}]")).select("_row", padded.alias("w"))
    places = {"l3": 1, "l2": 2, "l1": 3, "word": 4, "r1": 5, "r2": 6, "r3": 7}
    sides = [F.slice("w", F.lit(i), F.size("w") - 6).alias(c) for c, i in places.items()]
    return texts.select("_row", F.posexplode(F.arrays_zip(*sides)).alias("k", "s")).select("_row", "k", "s.*")


def _marked(df: DataFrame, asked: DataFrame, name: str) -> DataFrame:
    """The rows whose ``name`` may be among the ``asked``: a table of ``MARKS`` hashes at most goes to all tasks."""
    mark = F.pmod(F.xxhash64(name), F.lit(MARKS))
    marks = asked.select(mark.alias("_mark")).distinct()
    return df.withColumn("_mark", mark).join(F.broadcast(marks), "_mark", "left_semi").drop("_mark")


def totals(rows: DataFrame, text: str, patterns: DataFrame) -> DataFrame:
    """How often each of the ``patterns`` (``context``) stands around any word in all texts."""
    contexts = _slots(rows, text).select(F.explode(_contexts()).alias("context")).where("context is not null")
    # counted first, so that a row per context meets the ones asked for
    return _marked(contexts, patterns, "context").groupBy("context").agg(F.count("*").alias("total")).join(patterns.select("context"), "context")


def _seed_edges(rows: DataFrame, text: str) -> DataFrame:
    """``context, value, n`` of the spans of the fixed kinds, whatever they are made of."""
    near = rf"\A[^{SPACE}]*+((?:[{SPACE}]++[^{SPACE}]++){{0,3}})"
    spans = rows.where(F.size("base") > 0).select(F.col(text).alias("t"), F.explode("base").alias("b"))
    before = F.reverse(F.regexp_extract(F.reverse(F.substr("t", F.lit(1), F.col("b.start"))), near, 1))
    after = F.regexp_extract(F.substr("t", F.col("b.end") + 1), near, 1)

    def words(part: Column) -> Column:
        return F.filter(F.split(F.lower(part), rf"[{SPACE}]+"), lambda w: w != "")

    none = F.lit(None).cast("string")
    left = F.concat(F.array(none, none, F.lit(EDGE)), words(before)).alias("l")
    right = F.concat(words(after), F.array(F.lit(EDGE), none, none)).alias("r")
    sides = spans.select(F.col("b.value").alias("value"), left, right)
    sides = sides.withColumns({f"l{i}": F.get("l", F.size("l") - i) for i in (1, 2, 3)} | {f"r{i}": F.get("r", F.lit(i - 1)) for i in (1, 2, 3)})
    found = sides.select("value", F.explode(_contexts()).alias("context")).where("context is not null")
    return found.groupBy("context", "value").agg(F.count("*").alias("n"))


def _placed(slots: DataFrame, rows: DataFrame, text: str, shortest: int) -> DataFrame:
    """``slots`` with ``start, end, value`` of their words, without the punctuation around them.

    Words that overlap a fixed span or are too short are left out.
    """
    texts = rows.join(slots.select("_row").distinct(), "_row", "left_semi")
    pieces = texts.select("_row", F.posexplode(_pairs(F.col(text), WORD)).alias("k", "p")).where("p.match is not null")
    so_far = Window.partitionBy("_row").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.length("p.gap") + F.length("p.match")).over(so_far).cast("int")
    words = pieces.select("_row", "k", F.col("p.match").alias("match"), stop.alias("stop"))
    lead = F.length(F.regexp_extract("match", r"\A[^\p{L}\p{N}]*+", 0))
    value = F.regexp_replace(F.substr("match", lead + 1), r"[^\p{L}\p{N}]++\z", "")
    start = F.col("stop") - F.length("match") + lead
    words = slots.join(words, ["_row", "k"]).withColumns({"value": value, "start": start})
    words = words.withColumn("end", F.col("start") + F.length("value")).where(F.length("value") >= shortest)
    fixed = rows.where(F.size("base") > 0).select("_row", "base")
    overlap = F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
    free = words.join(fixed, "_row", "left").where(~F.coalesce(overlap, F.lit(False)))
    return free.drop("base", "match", "stop")


def _behind(rows: DataFrame, text: str, patterns: DataFrame, shortest: int) -> DataFrame:
    """``_row, start, end, value, context`` of every word in one of the ``patterns``."""
    contexts = _slots(rows, text).select("_row", "k", F.explode(_contexts()).alias("context")).where("context is not null")
    slots = staged(_marked(contexts, patterns, "context").join(patterns.select("context"), "context"))
    return _placed(slots, rows, text, shortest).select("_row", "start", "end", "value", "context")


def _bare(word: str) -> Column:
    return F.regexp_replace(word, r"\A[^\p{L}\p{N}]++|[^\p{L}\p{N}]++\z", "")


def _edges_of(rows: DataFrame, text: str, values: DataFrame, shortest: int) -> tuple[DataFrame, DataFrame]:
    """All places where one of the ``values`` stands as a word, with its neighbours; and ``context, value, n`` of them."""
    slots = _slots(rows, text).withColumn("bare", _bare("word"))
    slots = staged(_marked(slots, values.select(F.lower("value").alias("bare")), "bare").drop("bare", "word"))
    there = staged(_placed(slots, rows, text, shortest).join(values, "value"))
    found = there.select("value", F.explode(_contexts()).alias("context")).where("context is not null")
    return there, found.groupBy("context", "value").agg(F.count("*").alias("n"))


def _places(rows: DataFrame, text: str, values: DataFrame) -> DataFrame:
    """``low, places``: how often each of the ``values``, in lower case, stands as a word in all texts."""
    asked = values.select(F.lower("value").alias("low")).distinct()
    words = _slots(rows, text).select(_bare("word").alias("low"))
    return _marked(words, asked, "low").groupBy("low").agg(F.count("*").alias("places")).join(asked, "low")


def _with(before: DataFrame | None, more: DataFrame) -> DataFrame:
    return staged(more if before is None else before.unionByName(more))


def _instance_scores(found: DataFrame, trusted: DataFrame, places: DataFrame, rules: Bootstrap) -> DataFrame:
    """``value, score`` of the instances found in the ``trusted`` contexts."""
    met = found.join(trusted, "context")
    missed = F.exp(F.sum(F.log(F.greatest(1 - F.col("strength"), F.lit(1e-9)))))
    # one context alone gives its strength as it is
    right = F.greatest(F.max("strength"), 1 - missed).alias("right")
    chance = met.select("value", "context", "strength").distinct().groupBy("value").agg(right)
    inside = met.select(F.lower("value").alias("low"), "_row", "start").distinct()
    share = inside.groupBy("low").agg(F.count("*").alias("inside")).join(places, "low")
    against = rules.outside * F.greatest(F.col("places") - F.col("inside"), F.lit(0))
    share = share.select("low", (F.col("inside") / (F.col("inside") + against)).alias("share"))
    scored = chance.withColumn("low", F.lower("value")).join(share, "low")
    return scored.select("value", (F.col("right") * F.col("share")).alias("score"))


def bootstrap(rows: DataFrame, text: str, rules: Bootstrap, given: DataFrame | None = None) -> DataFrame | None:
    """``_row, start, end, value, context`` of the discovered identifiers, or None without any.

    ``rows`` has ``_row``, the text and its fixed spans (``base``), which are the seeds
    beside the ``given`` values. Seeds score 1. A context scores the mean over everything
    that stands in it anywhere, other words counting 0. An instance scores the chance
    that at least one of its contexts is right, times the share of its places that speak
    for it: a place in a trusted context counts 1 for it, one elsewhere ``outside``
    against it, whatever its case. So an everyday word that happens to stand behind a
    cue is not an identifier.

    Contexts are trusted that have ``support`` distinct instances and reach
    ``confidence``. Every word in a trusted context is an instance, and all places where
    it stands lead to further contexts, until no new one is trusted. In the end only
    instances that reach ``confidence`` themselves are kept, at their places in trusted
    contexts, and given values wherever they stand (with context ``''``).

    Contexts too weak to be trusted give no score, so only words in trusted ones are
    ever looked at; of the others only totals are counted.
    """
    edges = _seed_edges(rows, text)
    listed = None
    if given is not None:
        given = staged(given.select("value").where("value is not null").distinct())
        there, more = _edges_of(rows, text, given, 1)
        listed = there.select("_row", "start", "end", "value", F.lit("").alias("context"))
        edges = edges.unionByName(more).groupBy("context", "value").agg(F.sum("n").alias("n"))
    edges = staged(edges)
    seeds = edges.select("value") if given is None else edges.select("value").unionByName(given)
    seeds = staged(seeds.distinct().withColumn("score", F.lit(1.0)))
    scores, sizes, seen, found, places, known = seeds, None, None, None, None, seeds.select("value")
    trusted, done = None, 0
    while rules.rounds is None or done < rules.rounds:
        done += 1
        mass = edges.join(scores, "value").groupBy("context")
        sure = F.count_if(F.col("score") >= rules.confidence)
        mass = mass.agg(F.sum(F.col("n") * F.col("score")).alias("mass"), F.sum("n").alias("n"), sure.alias("support"))
        mass = staged(mass.where(F.col("support") >= rules.support))
        asked = staged(mass.select("context") if sizes is None else mass.select("context").join(sizes, "context", "left_anti"))
        if not asked.isEmpty():
            sizes = _with(sizes, totals(rows, text, asked))
        if sizes is None:
            break
        strength = (F.col("mass") / F.greatest("total", "n")).alias("strength")
        patterns = staged(mass.join(sizes, "context").select("context", strength).where(F.col("strength") >= rules.confidence))
        # a context may lose its trust and win it again; its places are known then
        new = patterns.select("context") if seen is None else patterns.select("context").join(seen, "context", "left_anti")
        new = staged(new)
        if new.isEmpty():
            break
        trusted, seen = patterns, _with(seen, new)
        found = _with(found, _behind(rows, text, new, rules.shortest))
        fresh = staged(found.select("value").distinct().join(known, "value", "left_anti"))
        if not fresh.isEmpty():
            lows = fresh.select(F.lower("value").alias("value")).distinct()
            lows = lows if places is None else lows.join(places.select(F.col("low").alias("value")), "value", "left_anti")
            places = _with(places, _places(rows, text, lows))
            edges = _with(edges, _edges_of(rows, text, fresh, rules.shortest)[1])
            known = staged(known.unionByName(fresh))
        if places is None:
            break
        # seeds keep their score
        others = _instance_scores(found, trusted, places, rules).join(seeds, "value", "left_anti")
        scores = staged(seeds.unionByName(others))
    if found is None or places is None:
        return listed
    sure = scores.where(F.col("score") >= rules.confidence).join(seeds, "value", "left_anti")
    kept = found.join(trusted.select("context"), "context", "left_semi").join(sure, "value", "left_semi")
    kept = kept.select("_row", "start", "end", "value", "context")
    return kept if listed is None else kept.unionByName(listed)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def find_spans(
    df: DataFrame, text: str = "text", rules: Bootstrap = Bootstrap(), seeds: DataFrame | None = None
) -> DataFrame:
    """``df`` with ``spans`` (start, kind, end, value; sorted) and ``base``, those of the fixed kinds.

    Fixed kinds are matched in every text and are the seeds. One to three whole words
    before or behind, text ends included, are contexts. Contexts that seeds share are
    scored on the graph of contexts and instances (``bootstrap``), and a word in a trusted
    context becomes a span of kind ``id`` if it does not mostly stand elsewhere and
    overlaps no fixed span. ``seeds`` (``value``) names single words known as identifiers;
    they are spans of kind ``id`` wherever they stand, and lead to contexts as the fixed
    kinds do. In spans ``kind`` is the place in ``KINDS``.

    Null and empty texts have no spans. Every row is judged by itself, also if its id or
    the whole row is repeated. Input columns with the names of the results are
    replaced. An empty table gives an empty result. Texts are read whole.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    # written before it is used twice, so the row numbers stay as they are
    rows = staged(df.withColumns({"base": base_spans(whole), "_row": F.monotonically_increasing_id()}))
    found = bootstrap(rows, text, rules, seeds)
    if found is None:
        return rows.withColumn("spans", F.col("base")).drop("_row")
    span = F.struct("start", F.lit(KINDS.index("id")).alias("kind"), "end", "value")
    more = found.groupBy("_row").agg(F.collect_set(span).alias("_more"))
    spans = F.sort_array(F.concat("base", F.coalesce("_more", F.array().cast(f"array<{SPAN}>"))))
    return rows.join(more, "_row", "left").withColumn("spans", spans).drop("_row", "_more")


def summary(spans: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts per fixed kind, the digest of the fixed spans and the list of all spans."""

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    digest = F.sha2(_joined(F.col("base")), 256).alias("base_sha256")
    return spans.select(id, *map(number, KINDS[:4]), digest, _joined(F.col("spans")).alias("spans"))


def redact(
    df: DataFrame, text: str = "text", rules: Bootstrap = Bootstrap(), seeds: DataFrame | None = None
) -> DataFrame:
    """``df`` with every span of its texts replaced by its kind in angle brackets.

    Where spans overlap, the text from the first start to the last end goes under the
    kind of the first. Null texts stay null; otherwise as ``find_spans``.
    """
    whole = df.select(F.struct("*").alias("_whole"), F.col(text).alias("_text"))
    found = find_spans(whole, "_text", rules, seeds)
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substr(F.col("_text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when(s["start"] >= acc["at"], F.get(names, s["kind"])).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], kept, mark).alias("out"))

    def close(acc: Column) -> Column:
        return F.concat(acc["out"], F.substr(F.col("_text"), acc["at"] + 1, F.length("_text")))

    clean = F.when(F.size("spans") == 0, F.col("_text")).otherwise(F.aggregate("spans", start, step, close))
    clean = F.when(F.col("_text").isNotNull(), clean)
    return found.select(*[clean.alias(c) if c == text else F.col("_whole").getField(c).alias(c) for c in df.columns])
