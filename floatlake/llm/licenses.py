"""License scans by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floatlake.llm.common import real_id, row_id

#: Words of one k-gram.
GRAM = 3
#: Diagonals up to this far apart are one place: so many words may be put in or left out.
DRIFT = 4
#: Share of a template's words that verified k-grams must cover.
COVERED = 0.8
#: Up to so many template k-grams, hash ends are tested before the join.
FILTER_GRAMS = 10_000

# Phrases that stand for a label wherever they occur.
BASE_PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

# License notices, as words of letters and digits.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-4.0": "licensed under cc by 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "mit": "released under the mit license",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "public-domain": "this is free and unencumbered software released into the public domain",
}

_GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def license_words(text: Column) -> Column:
    """Runs of a-z, digits and characters beyond ASCII, after lower-casing.

    lower() also changes letters beyond ASCII. They are parts of words before and after it, so
    the words stand at the same places.
    """
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _GAPS), "")


def _spaced(words: Column) -> Column:
    """The words, each with a space of its own on both sides, so that phrases can touch."""
    return F.when(F.size(words) > 0, F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))).otherwise("")


def phrase_places(spaced: Column, n_words: Column, phrase: str) -> dict[str, Column]:
    """How often a phrase stands in the words, and the first and last word it starts at."""
    own = phrase.split()
    needle = "".join(f" {word} " for word in own)
    taken = F.char_length(spaced) - F.char_length(F.replace(spaced, F.lit(needle), F.lit("")))
    count = (taken / len(needle)).cast("long")
    before = F.substring_index(spaced, needle, 1)
    after = F.substring_index(spaced, needle, -1)
    return {
        "n": count, "first": F.when(count > 0, _words_in(before)),
        "last": F.when(count > 0, n_words - _words_in(after) - len(own)),
    }


def _words_in(spaced: Column) -> Column:
    return ((F.char_length(spaced) - F.char_length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("long")


def base_places(docs: DataFrame, phrases: dict[str, str], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`did, t, n_words, n_base, first_word, last_word, base` (labels) of every row."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(row_id(id_column).alias("did"), F.xxhash64(text).alias("t"), license_words(text).alias("words"))
    rows = rows.select("did", "t", F.size("words").cast("long").alias("n_words"), _spaced(F.col("words")).alias("spaced"))
    names = sorted(phrases)
    places = {name: phrase_places(F.col("spaced"), F.col("n_words"), phrases[name]) for name in names}
    counted = rows.select("did", "t", "n_words", *(
        F.struct(*(x.alias(k) for k, x in places[name].items())).alias(f"p{i}") for i, name in enumerate(names)
    ))
    some = [F.col(f"p{i}") for i in range(len(names))]
    found = F.array_compact(F.array(*(F.when(x["n"] > 0, F.lit(name)) for x, name in zip(some, names, strict=True))))
    return counted.select(
        "did", "t", "n_words", reduce(Column.__add__, (x["n"] for x in some)).alias("n_base"),
        F.array_min(F.array(*(x["first"] for x in some))).alias("first_word"),
        F.array_max(F.array(*(x["last"] for x in some))).alias("last_word"), found.alias("base"),
    )


def grams(words: DataFrame, keys: list[str], wanted: list[int] | None = None) -> DataFrame:
    """`keys`, `pos`, `h`, `g`: every GRAM consecutive words, hashed and written out.

    `wanted` is an array of longs, a power of two long: only grams whose hash ends in the
    number of a set bit are written out.
    """
    hashed = words.filter(F.size("words") >= GRAM).select(*keys, "words", F.transform("words", lambda w: F.xxhash64(w)).alias("each"))
    gram = lambda i: F.xxhash64(*(F.get("each", i + k) for k in range(GRAM)))
    places = F.sequence(F.lit(0), F.size("words") - GRAM)
    if wanted is not None:
        places = F.filter(places, lambda i: _bit(wanted, gram(i)))
    placed = F.transform(places, lambda i: F.struct(
        i.alias("pos"), gram(i).alias("h"), F.concat_ws(" ", *(F.get("words", i + k) for k in range(GRAM))).alias("g")
    ))
    return hashed.select(*keys, F.explode(placed).alias("x")).select(*keys, "x.pos", "x.h", "x.g")


def _bit(wanted: list[int], value: Column) -> Column:
    """Whether the bit numbered by the end of a hash is set."""
    word = F.get(F.array(*map(F.lit, wanted)), F.shiftrightunsigned(value, 6).bitwiseAND(F.lit(len(wanted) - 1)).cast("int"))
    return F.getbit(word, value.bitwiseAND(F.lit(63)).cast("int")) == 1


def gram_filter(known: DataFrame) -> list[int] | None:
    """Hash ends of the template grams as bits; none for over FILTER_GRAMS of them."""
    n = known.count()
    if n > FILTER_GRAMS:
        return None
    size = 1 << max(10, (64 * n).bit_length())
    ends = known.select(F.col("h").bitwiseAND(F.lit(size - 1)).alias("e")).distinct().collect()
    words = [0] * (size // 64)
    for row in ends:
        words[row.e >> 6] |= 1 << (row.e & 63)
    return [w - (1 << 64) if w >> 63 else w for w in words]


def license_spans(
    docs: DataFrame, templates: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    covered: float = COVERED,
) -> DataFrame:
    """`did, t, label, first_word, last_word, score`: places of templates (`label`, `text`) in documents.

    All k-grams of words of every text meet the template positions in a join, by hash and then
    word by word; those whose hash ends like no template's are left out before it. Hits are counted by diagonal (place in the text less place in the template);
    diagonals at most DRIFT apart are one place, since words put in or left out shift the rest.
    A place holds if its k-grams cover `covered` of the template's words and it is not longer
    than the template by over half; the share covered is its score. In a place that is too
    long, runs of its diagonals that hold by themselves are taken.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(row_id(id_column).alias("did"), F.xxhash64(text).alias("t"), license_words(text).alias("words"))
    known = templates.select("label", license_words(F.col("text")).alias("words")).withColumn("size", F.size("words"))
    known = grams(known, ["label", "size"]).withColumnsRenamed({"pos": "tpos", "g": "tg"})
    wanted = gram_filter(known)
    # Few enough for the filter is few enough to broadcast; more are left to Spark.
    hits = grams(rows, ["did", "t"], wanted).join(known if wanted is None else F.broadcast(known), "h").filter(F.col("g") == F.col("tg"))
    place = ["did", "t", "label", "size"]
    diagonals = hits.groupBy(*place, (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.collect_set("tpos").alias("at"), F.min("pos").alias("first"), F.max("pos").alias("last")
    )
    own = Window.partitionBy(*place).orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(own) > DRIFT).cast("int"), F.lit(0))
    merged = (
        diagonals.withColumn("apart", apart).withColumn("number", F.sum("apart").over(own))
        .groupBy(*place, "number").agg(F.sort_array(F.collect_list(F.struct("diagonal", "at", "first", "last"))).alias("own"))
    )
    size = F.col("size")
    whole = _span(F.col("own"), size)
    held = F.when(_short(whole, size), F.array(whole)).otherwise(_held_runs(F.col("own"), size, covered))
    return merged.filter(whole["score"] >= covered).select("did", "t", "label", F.explode(held).alias("x")).select(
        "did", "t", "label", F.col("x.first").alias("first_word"), F.col("x.last").alias("last_word"), "x.score"
    )


def _span(diagonals: Column, size: Column) -> Column:
    """`first, last, score` of some diagonals (`at`, `first`, `last`) of a template of `size` words."""
    at = F.flatten(F.transform(diagonals, lambda d: d["at"]))
    words = F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(p, p + GRAM - 1))))
    return F.struct(
        F.array_min(F.transform(diagonals, lambda d: d["first"])).cast("long").alias("first"),
        (F.array_max(F.transform(diagonals, lambda d: d["last"])) + GRAM - 1).cast("long").alias("last"),
        (F.size(words) / size).alias("score"),
    )


def _short(span: Column, size: Column) -> Column:
    return (span["last"] - span["first"] + 1) * 2 <= size * 3


def _held_runs(diagonals: Column, size: Column, covered: float) -> Column:
    """Spans of neighbouring diagonals that hold, best score first, then the shortest; none overlaps a better one.

    Hits of a span that is not too long are on diagonals less than 2.5 times the template apart.
    """
    n = F.size(diagonals)
    runs = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(n - i + 1, size * 3)), lambda k: _span(F.slice(diagonals, i, k), size)
    )))
    good = F.filter(runs, lambda x: (x["score"] >= covered) & _short(x, size))
    ranked = F.sort_array(F.transform(good, lambda x: F.struct(
        (-x["score"]).alias("worse"), (x["last"] - x["first"]).alias("length"), x["first"].alias("first"), x["last"].alias("last"), x["score"].alias("score")
    )))
    best = F.transform(ranked, lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last"), x["score"].alias("score")))
    return F.aggregate(best, F.slice(best, 1, 0), lambda kept, x: F.when(
        F.exists(kept, lambda y: (y["first"] <= x["last"]) & (x["first"] <= y["last"])), kept
    ).otherwise(F.concat(kept, F.array(x))))


def scan_licenses(
    docs: DataFrame, templates: DataFrame | None = None, phrases: dict[str, str] | None = None,
    id_column: str = "doc_id", text_column: str = "text", covered: float = COVERED,
) -> DataFrame:
    """`doc_id, n_words, n_base, first_word, last_word, base, labels, score, spans` of every row.

    `n_base`, `first_word`, `last_word` and `base` tell where the phrases stand; `spans` are the
    template places, and `labels` all labels of both, distinct and sorted. `score` is 1 with a
    phrase, else the best span's, else 0. A null text has no word; rows of one id and text share
    their spans; a null id stays null; an empty table gives no row.
    """
    if templates is None:
        templates = docs.sparkSession.createDataFrame(sorted(TEMPLATES.items()), "label string, text string")
    base = base_places(docs, phrases or BASE_PHRASES, id_column, text_column)
    spans = license_spans(docs, templates, id_column, text_column, covered).groupBy("did", "t").agg(
        F.sort_array(F.collect_list(F.struct("first_word", "last_word", "label", "score"))).alias("spans")
    )
    none = F.from_json(F.lit("[]"), "array<struct<first_word:bigint,last_word:bigint,label:string,score:double>>")
    joined = base.join(spans, ["did", "t"], "left").withColumn("spans", F.coalesce("spans", none))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform("spans", lambda x: x["label"]))))
    best = F.coalesce(F.array_max(F.transform("spans", lambda x: x["score"])), F.lit(0.0))
    return joined.select(
        real_id("did").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base", labels.alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.least(best, F.lit(1.0))).alias("score"), "spans",
    )
