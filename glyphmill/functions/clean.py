"""Cleaning raw lines, cutting sentences, and how much of a sentence is marked."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profile import HEBREW, LETTERS, MARKS, VOWELS, ScriptProfile
from .text import words

SPACE = "[\\s\\p{Z}]"


def clean_line(text: Column, latin: bool = True) -> Column:
    """Tags, braces, short brackets, footnote signs and (latin) runs of Latin letters go; white space becomes single spaces. The order matters."""
    for pattern, by in (("<[^>]{0,200}>", " "), ("\\{[^}]{0,200}\\}", " "), ("\\[[^\\]]{0,4}\\]", " "), ("[*†‡°]", "")):
        text = F.regexp_replace(text, pattern, by)
    if latin:
        text = F.regexp_replace(text, "[A-Za-z]{2,}", " ")
    return F.trim(F.regexp_replace(F.translate(text, "[]{}", ""), f"{SPACE}+", " "))


def sentences(text: Column, profile: ScriptProfile = HEBREW, least: int = 3, most: int = 60) -> Column:
    """Sentences of at least `least` words. Longer ones than `most` are cut behind commas as soon as `most` words are gathered; shorter rests are dropped."""
    count = lambda t: F.size(words(t, profile))
    # A bare F.trim would get a chunk's number as the characters to trim.
    chunks = F.filter(F.transform(F.split(text, profile.sentence_end, -1), lambda c: F.trim(c)), lambda c: count(c) >= least)

    def chop(chunk: Column) -> Column:
        start = F.struct(F.array().cast("array<string>").alias("out"), F.array().cast("array<string>").alias("buf"), F.lit(0).alias("n"))

        def step(a: Column, piece: Column) -> Column:
            buf, n = F.concat(a["buf"], F.array(piece)), a["n"] + count(piece)
            full = n >= most
            return F.struct(
                F.when(full, F.concat(a["out"], F.array(F.trim(F.array_join(buf, " "))))).otherwise(a["out"]).alias("out"),
                F.when(full, F.array().cast("array<string>")).otherwise(buf).alias("buf"),
                F.when(full, F.lit(0)).otherwise(n).alias("n"),
            )

        done = lambda a: F.when((F.size(a["buf"]) > 0) & (a["n"] >= least), F.concat(a["out"], F.array(F.trim(F.array_join(a["buf"], " "))))).otherwise(a["out"])
        return F.aggregate(F.split(chunk, "(?<=,)\\s+", -1), start, step, done)

    return F.flatten(F.transform(chunks, lambda c: F.when(count(c) <= most, F.array(c)).otherwise(chop(c))))


def coverage(text: Column) -> Column:
    """struct(words, letters): the shares that carry a vowel; 0 without words."""
    w = words(text)
    n = F.size(w)
    with_vowel = F.size(F.filter(w, lambda t: t.rlike(f"[{VOWELS}]")))
    letters = F.size(F.regexp_extract_all(F.array_join(w, " "), F.lit(f"[{LETTERS}]"), F.lit(0)))
    voweled = F.size(F.regexp_extract_all(F.array_join(w, " "), F.lit(f"[{LETTERS}][{MARKS}]*?[{VOWELS}]"), F.lit(0)))
    return F.struct(F.when(n > 0, with_vowel / n).otherwise(0.0).alias("words"), F.when(letters > 0, voweled / letters).otherwise(0.0).alias("letters"))


def is_fully_marked(text: Column, profile: ScriptProfile = HEBREW) -> Column:
    if profile.coverage is None:
        return F.lit(True)
    c = coverage(text)
    return (c["words"] >= profile.coverage[0]) & (c["letters"] >= profile.coverage[1])
