"""Keyed permutations of digit strings, as columns.

An alternating Feistel network over the two halves of the digits: each round
adds a keyed hash of one half to the other, modulo its size, and swaps them.
Every round can be undone, so different texts of one length have different
images of the same length, without a table, and a key gives the same images in
every load.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ROUNDS = 8  # even, so that the halves end where they began
LONGEST = 18


def _hashed(key: str, number: Column, half: Column) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(key), number.cast("string"), half.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")


def permuted_digits(text: Column, key: str) -> Column:
    """The image of a text of 1 to 18 digits; null and blank stay, any other text fails the job."""
    powers = F.array(*(F.lit(10**i).cast("bigint") for i in range(LONGEST + 1)))
    digits = F.length(text)
    low = F.get(powers, F.floor(digits / 2).cast("int"))
    high = F.get(powers, (digits - F.floor(digits / 2)).cast("int"))
    number = text.cast("bigint")
    halves = F.struct(
        F.call_function("div", number, low).alias("x"), (number % low).alias("y"), high.alias("x_size"), low.alias("y_size"),
    )

    def turn(state: Column, number: Column) -> Column:
        mixed = (state["x"] + _hashed(key, number, state["y"])) % state["x_size"]
        return F.struct(state["y"].alias("x"), mixed.alias("y"), state["y_size"].alias("x_size"), state["x_size"].alias("y_size"))

    joined = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), halves, turn, lambda state: state["x"] * state["y_size"] + state["y"]
    )
    image = F.lpad(joined.cast("string"), digits, "0")
    fault = F.raise_error(F.lit("only texts of up to 18 digits have a keyed image")).cast("string")
    return F.when(text.isNull() | (F.trim(text) == ""), text).when(text.rlike(f"^[0-9]{{1,{LONGEST}}}$"), image).otherwise(fault)
