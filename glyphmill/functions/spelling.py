"""Full and defective spelling: silent letters, their removal, restoration, and the way back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profile import HIRIQ, HOLAM, QUBUTS, VAV, YOD
from .text import compose, is_letter, letter_slots, slot, slots


def mater_positions(text: Column, yod: bool = True, vav: bool = True, holam: bool = False) -> Column:
    """array of (pos, vowel): silent letters among a word's letters and the vowel that stands for each without it; never the first or last letter."""
    s = letter_slots(text)
    n = F.size(s)
    plural = (n >= 4) & F.try_element_at(s, F.lit(-1))["base"].isin("ם", "ן") & (F.try_element_at(s, F.lit(-2))["base"] == YOD)

    def kind(i: Column) -> Column:
        x, prev = F.element_at(s, i + 1), F.element_at(s, i)
        silent_yod = F.lit(yod) & (x["base"] == YOD) & (x["vowel"] == "") & ~x["dagesh"] & (prev["vowel"] == HIRIQ) & ~(F.coalesce(plural, F.lit(False)) & (i == n - 2))
        shuruk = F.lit(vav) & (x["base"] == VAV) & x["dagesh"] & (x["vowel"] == "") & (prev["vowel"] == "")
        full_holam = F.lit(vav and holam) & (x["base"] == VAV) & ~x["dagesh"] & (x["vowel"] == HOLAM) & (prev["vowel"] == "")
        return F.when(silent_yod, HIRIQ).when(shuruk, QUBUTS).when(full_holam, HOLAM)

    inner = F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(inner, lambda i: F.struct(i.alias("pos"), kind(i).alias("vowel"))), lambda x: x["vowel"].isNotNull())


def mechanical(text: Column, removed: Column) -> Column:
    """The word without the letters at removed: array of (pos, vowel); each vowel goes to the letter before."""
    s = slots(text)
    numbered = F.aggregate(
        s,
        F.struct(F.lit(0).alias("n"), F.transform(F.slice(s, 1, 0), lambda x: F.struct(x.alias("s"), F.lit(0).alias("k"))).alias("out")),
        lambda a, x: F.struct((a["n"] + is_letter(x).cast("int")).alias("n"), F.concat(a["out"], F.array(F.struct(x.alias("s"), F.when(is_letter(x), a["n"]).otherwise(-1).alias("k")))).alias("out")),
        lambda a: a["out"],
    )
    kept = F.filter(numbered, lambda r: ~F.exists(removed, lambda d: d["pos"] == r["k"]))
    moved = F.transform(kept, lambda r: slot(r["s"]["base"], F.coalesce(F.try_element_at(F.transform(F.filter(removed, lambda d: d["pos"] == r["k"] + 1), lambda d: d["vowel"]), F.lit(1)), r["s"]["vowel"]), r["s"]["dagesh"], r["s"]["shin"]))
    return compose(moved)


def restore(skeleton: Column, removed: Column) -> Column:
    """removed: array of (pos, letter); inserted in ascending order of position."""
    return F.aggregate(F.array_sort(removed), skeleton, lambda t, r: F.concat(F.substring(t, F.lit(1), r["pos"]), r["letter"], F.substring(t, r["pos"] + 1, F.length(t))))


def to_male(text: Column) -> Column:
    """Adds a yod after hiriq and turns qubuts into vav with dagesh, where such spellings are really written."""
    s = slots(text)
    letters = F.transform(F.filter(s, is_letter), lambda x: x["base"])
    start = F.struct(F.lit(0).alias("n"), F.slice(s, 1, 0).alias("out"))

    def step(a: Column, x: Column) -> Column:
        n = a["n"] + is_letter(x).cast("int")
        nxt = F.coalesce(F.try_element_at(letters, n + 1), F.lit(""))
        free = is_letter(x) & ~x["base"].isin(YOD, VAV) & (nxt != "") & ~nxt.isin("א", "ה")
        add_yod, add_vav = free & (x["vowel"] == HIRIQ) & (nxt != YOD), free & (x["vowel"] == QUBUTS) & (nxt != VAV)
        kept = slot(x["base"], F.when(add_vav, "").otherwise(x["vowel"]), x["dagesh"], x["shin"])
        new = F.when(add_yod, F.array(kept, slot(F.lit(YOD), F.lit(""), F.lit(False), F.lit("")))).when(add_vav, F.array(kept, slot(F.lit(VAV), F.lit(""), F.lit(True), F.lit("")))).otherwise(F.array(kept))
        return F.struct(n.alias("n"), F.concat(a["out"], new).alias("out"))

    return compose(F.aggregate(s, start, step, lambda a: a["out"]))
