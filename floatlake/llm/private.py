"""Personal data: base patterns, and more identifiers by the words around them. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floatlake.llm.common import Workspace, real_id, row_id

#: Base kinds, in the order that breaks ties.
KINDS = ("email", "ip", "card", "phone")
#: Stands for the kind of an identifier-like token that is no base span.
TOKEN = len(KINDS)
#: Code points before and after a place that its words are taken from.
BEFORE, AFTER = 48, 24
#: What a pattern must hold: confidence of its instances together, and its share of them. A token of the
#: right form that nothing is known of counts against a pattern by so much.
LEAST_SUPPORT, LEAST_SCORE, UNKNOWN = 4.0, 0.6, 0.5
#: Turns of patterns to instances and back.
ROUNDS = 3

# The base patterns, written so that Java's matcher takes linear time and no stack: runs are never given
# back (which can't change a match, since what follows a run isn't in it), and a match starts where a
# run starts or where the last match ended.
_MATCHERS = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    # A token: a number in groups, or a word with a digit or an at sign.
    r"(?<![\p{L}\p{N}])\+?\(?[0-9]++(?:[\x20().-]{1,2}+[0-9]++)*+(?![\p{L}\p{N}@_%])"
    r"|(?<![\p{L}\p{N}._%+@-])[A-Za-z._%+-]*+[0-9@][A-Za-z0-9@._%+-]*+",
)
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_WORD = r"\p{L}+|[0-9]+"
#: Forms that a token must have to be of a kind.
_FORMS = (r"^[^@]+@[^@]+$", r"^[0-9A-Fa-f]{1,4}(?:[.:][0-9A-Fa-f]{0,4}){3,7}$", r"^[0-9 .-]+$", r"^[0-9 ().+-]+$")
_DIGITS = (None, None, (12, 19), (7, 15))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the check of card numbers."""
    def value(i: Column) -> Column:
        digit = F.substring(digits, -1 * i, F.lit(1)).cast("int")
        doubled = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    places = F.sequence(F.lit(1), F.char_length(digits))
    return F.aggregate(places, F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def _holds(kind: int, match: Column) -> Column:
    """Whether a match of a base pattern is a span."""
    if kind == 1:
        return F.rlike(match, F.lit(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"))
    digits = _digits(match)
    if kind == 2:
        return F.when(F.char_length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    return F.char_length(digits).between(10, 15) if kind == 3 else F.lit(True)


def _forms(token: Column) -> Column:
    """Bits of the kinds whose form a token has."""
    count = F.char_length(_digits(token))
    bits = [
        F.when(F.rlike(token, F.lit(form)) & (F.lit(True) if span is None else count.between(*span)), 1 << kind).otherwise(0)
        for kind, (form, span) in enumerate(zip(_FORMS, _DIGITS, strict=True))
    ]
    return reduce(Column.bitwiseOR, bits)


def _plain(word: Column) -> Column:
    return F.when(F.rlike(word, F.lit("^[0-9]")), "#").otherwise(word)


def _contexts(before: Column, first: Column, after: Column) -> Column:
    """Patterns of a place: two words before it, one word, one word before and one after.

    `#` is a number or an earlier match, `^` the start and `$` the end of the text (or no word near).
    """
    words = F.concat(F.array(F.when(first, "^").otherwise("#")), F.regexp_extract_all(F.lower(F.right(before, F.lit(BEFORE))), F.lit(_WORD), 0))
    last = _plain(F.element_at(words, -1))
    left = F.when(F.size(words) > 1, _plain(F.element_at(words, -2)))
    found = F.regexp_extract(F.lower(F.substring(after, 1, AFTER)), _WORD, 0)
    right = F.when(found == "", "$").otherwise(_plain(found))
    return F.array_compact(F.array(
        F.concat(left, F.lit(" "), last, F.lit(" _")), F.concat(last, F.lit(" _")), F.concat(last, F.lit(" _ "), right)
    ))


def _matches(kind: int) -> Column:
    """All matches of a kind as an array: what is before each, its length, and what is known of it."""
    pieces, found = F.col(f"pieces{kind}"), F.col(f"found{kind}")

    def place(match: Column, j: Column) -> Column:
        own = F.rtrim(match, F.lit("._%+@-")) if kind == TOKEN else match
        return F.struct(
            F.lit(kind).alias("k"), j.alias("j"), F.char_length(F.get(pieces, j)).alias("gap"), F.char_length(match).alias("taken"),
            F.char_length(own).alias("length"), (F.lit(True) if kind == TOKEN else _holds(kind, match)).alias("ok"),
            F.xxhash64(F.lower(own)).alias("inst"), (_forms(own) if kind == TOKEN else F.lit(0)).alias("forms"),
            _contexts(F.get(pieces, j), j == 0, F.get(pieces, j + 1)).alias("contexts"),
        )

    return F.coalesce(F.transform(found, place), F.from_json(F.lit("[]"), _MATCH))


_MATCH = "array<struct<k:int,j:int,gap:int,taken:int,length:int,ok:boolean,inst:bigint,forms:int,contexts:array<string>>>"


def _scanned(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """`did, t, matches` of every row. Texts are cut at all matches, so that what lies between tells the places."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(row_id(id_column).alias("did"), F.xxhash64(text).alias("t"), text.alias("text"))
    number, at, plus = (F.rlike("text", F.lit("[0-9]")), F.contains("text", F.lit("@")), F.contains("text", F.lit("+")))
    needed = (at, number, number, plus & number, number | at)
    cut = rows.select("did", "t", *(
        F.when(need, x).alias(f"{name}{kind}")
        for kind, (matcher, need) in enumerate(zip(_MATCHERS, needed, strict=True))
        for name, x in (("pieces", F.split("text", matcher, -1)), ("found", F.regexp_extract_all("text", F.lit(matcher), 0)))
    ))
    return cut.select("did", "t", F.concat(*(_matches(kind) for kind in range(TOKEN + 1))).alias("matches"))


def _placed(scanned: DataFrame) -> DataFrame:
    """`did, t, k, start, stop, inst, forms, contexts`: base spans, and tokens that overlap none.

    Lengths are summed up and overlaps found by windows over one text's matches.
    """
    each = scanned.filter(F.size("matches") > 0).select("did", "t", F.explode("matches").alias("x")).select("did", "t", "x.*").distinct()
    upto = F.sum((F.col("gap") + F.col("taken")).cast("long")).over(Window.partitionBy("did", "t", "k").orderBy("j"))
    start = upto - F.col("taken")
    spans = each.withColumn("start", start).withColumn("stop", F.col("start") + F.col("length")).filter("ok")
    base = F.col("k") < TOKEN
    before = Window.partitionBy("did", "t").orderBy("start", "k")
    after = Window.partitionBy("did", "t").orderBy(F.desc("start"), F.desc("k"))
    marked = spans.withColumn("reach", F.max(F.when(base, F.col("stop"))).over(before)).withColumn("next", F.min(F.when(base, F.col("start"))).over(after))
    apart = (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("stop")) >= F.col("stop"))
    return marked.filter(base | apart).select("did", "t", "k", "start", "stop", "inst", "forms", "contexts")


def _scored(stats: DataFrame, extra: DataFrame | None, support: float, score: float) -> DataFrame:
    """`p, k, score` of patterns that hold, by their seeds and the confidence of the tokens they found."""
    found = F.lit(0.0) if extra is None else F.coalesce(F.col("found"), F.lit(0.0))
    rows = stats if extra is None else stats.join(extra, ["p", "k"], "left")
    held = F.col("seeds") + found
    against = F.col("total") - F.col("seeds") - F.col("unknown") + UNKNOWN * (F.col("unknown") - found)
    share = F.round(held / (held + against), 6)
    return rows.filter((F.round(held, 6) >= support) & (share >= score)).select("p", "k", share.alias("score"))


def _fits() -> Column:
    return F.getbit("forms", F.col("k")) == 1


def learned_patterns(
    spans: DataFrame, workspace: Workspace, support: float = LEAST_SUPPORT, score: float = LEAST_SCORE, rounds: int = ROUNDS
) -> DataFrame:
    """`p, k, score`: contexts that hold identifiers of a kind, learnt in turns from the base spans.

    Patterns and instances are the two sides of a graph of distinct edges, so that copies of a text
    count once. A pattern's score for a kind is the confidence it has gathered, over that
    plus the instances of other kinds or forms and UNKNOWN times the rest. Patterns that hold give
    their tokens of the right form a confidence (one less the chance that all are wrong), which
    counts for the other patterns in the next turn. A pattern must hold a base span.
    """
    edges = spans.select(F.explode("contexts").alias("p"), "inst", F.col("k").alias("own"), "forms")
    luring = edges.filter(F.col("own") < TOKEN).select("p").distinct()
    edges = workspace.save(edges.join(luring, "p", "left_semi").distinct(), "edges")
    counted = edges.groupBy("p").agg(
        F.count("*").alias("total"),
        *(F.count(F.when(F.col("own") == kind, 1)).alias(f"s{kind}") for kind in range(TOKEN)),
        *(F.count(F.when(F.col("forms").bitwiseAND(F.lit(1 << kind)) > 0, 1)).alias(f"u{kind}") for kind in range(TOKEN)),
    )
    by_kind = F.array(*(
        F.struct(F.lit(kind).alias("k"), F.col(f"s{kind}").alias("seeds"), F.col(f"u{kind}").alias("unknown")) for kind in range(TOKEN)
    ))
    stats = counted.select("p", "total", F.explode(by_kind).alias("x")).select("p", "total", "x.*")
    stats = workspace.save(stats.filter(f"seeds > 0 AND seeds + unknown >= {support}"), "stats")
    tokens = edges.filter((F.col("own") == TOKEN) & (F.col("forms") > 0)).select("p", "inst", "forms")
    patterns = workspace.save(_scored(stats, None, support, score), "patterns0")
    for turn in range(1, rounds):
        wrong = F.log(1 - F.least(F.col("score"), F.lit(0.999)))
        sure = tokens.join(patterns, "p").filter(_fits()).groupBy("inst", "k").agg((1 - F.exp(F.sum(wrong))).alias("sure"))
        sure = workspace.save(sure, f"instances{turn}")
        found = tokens.join(sure, "inst").filter(_fits()).groupBy("p", "k").agg(F.sum("sure").alias("found"))
        patterns = workspace.save(_scored(stats, found, support, score), f"patterns{turn}")
        workspace.drop(f"patterns{turn - 1}")
        workspace.drop(f"instances{turn}")
    return patterns


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["start"], x["stop"])), ",")


def personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    support: float = LEAST_SUPPORT, score: float = LEAST_SCORE, rounds: int = ROUNDS,
) -> DataFrame:
    """`doc_id, n_email, n_ip, n_card, n_phone, base, spans` of every row.

    `base` are the spans (`start, k, stop`, in code points, end exclusive, by start and then by the
    kind's number in KINDS) of the base patterns; `spans` also has the tokens that
    a learned pattern found, under the pattern's kind. Base spans always stay.

    One pass over the texts cuts them at all matches; only matches move from there. Windows hold one text's
    matches. A null or empty text has no span; rows of one id and text share their
    spans; a null id stays null; an empty table gives no row. Other columns play no part.
    """
    workspace = Workspace(docs.sparkSession, "private")
    scanned = workspace.save(_scanned(docs, id_column, text_column), "scanned")
    places = workspace.save(_placed(scanned), "places")
    patterns = learned_patterns(places, workspace, support, score, rounds)
    tokens = places.filter((F.col("k") == TOKEN) & (F.col("forms") > 0)).select("did", "t", "start", "stop", "forms", F.explode("contexts").alias("p"))
    found = tokens.join(patterns, "p").filter(_fits()).groupBy("did", "t", "start", "stop").agg(
        F.max(F.struct("score", (-F.col("k")).alias("rank")))["rank"].alias("rank")
    )
    base = places.filter(F.col("k") < TOKEN).select("did", "t", "start", "k", "stop", F.lit(True).alias("base"))
    every = base.unionByName(found.select("did", "t", "start", (-F.col("rank")).alias("k"), "stop", F.lit(False).alias("base")))
    span = F.struct("start", "k", "stop")
    gathered = every.groupBy("did", "t").agg(
        *(F.count(F.when(F.col("base") & (F.col("k") == kind), 1)).alias(f"n_{name}") for kind, name in enumerate(KINDS)),
        F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base_spans"), F.sort_array(F.collect_list(span)).alias("all_spans"),
    )
    joined = scanned.select("did", "t").join(gathered, ["did", "t"], "left")
    none = F.from_json(F.lit("[]"), "array<struct<start:bigint,k:int,stop:bigint>>")
    return joined.select(
        real_id("did").alias("doc_id"), *(F.coalesce(f"n_{name}", F.lit(0).cast("long")).alias(f"n_{name}") for name in KINDS),
        F.coalesce("base_spans", none).alias("base"), F.coalesce("all_spans", none).alias("spans"),
    )


def private_digest(found: DataFrame) -> DataFrame:
    """The spans as text: `kind:start:end`, joined by commas, the base ones hashed."""
    return found.select(
        "doc_id", *(f"n_{name}" for name in KINDS), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )
