"""Template rendering as row-local higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from outreach.functions.text import token_column, token_table
from outreach.params import DEFAULT_TEXT, NOT_FOUND


def resolved(value: Column) -> Column:
    """Value of a token, empty and NULL counting as missing."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(NOT_FOUND))


def parse(template: Column, file: Column, connection: Column) -> Column:
    """A template as an array of parts, done once per module and not once per message.

    A literal has `text`. A token `table.column` between two %% markers has instead its
    `column`, `own` (read from the traveler), and `name`, under which its value is
    reported: `column_1` for a traveler column, `column_<connection>` for a looked-up one.
    A token that names another file than the variable's join spec has no column. Text
    after an unpaired marker is a literal; NULL is the empty template.
    """
    pieces = F.split(F.coalesce(template, F.lit("")), "%%")

    def part(p: Column, i: Column) -> Column:
        is_token = (i % 2 == 1) & (i < F.size(pieces) - 1)
        own = token_table(p) == "traveler"
        number = F.when(own, F.lit("1")).otherwise(connection.cast("string"))
        return F.struct(
            F.when(~is_token, p).alias("text"),
            F.when(is_token & (own | (token_table(p) == file)), token_column(p)).alias("column"),
            own.alias("own"),
            F.when(is_token, F.lower(F.concat_ws("_", token_column(p), number))).alias("name"),
        )

    return F.transform(pieces, part)


def fill(parts: Column, attributes: Column, looked_up: Column) -> Column:
    """Parts with their values: array of (name, value); a literal has no name.

    `attributes` and `looked_up` are map<string,string>. Values go in by part position, so
    a token is never touched by the value of another.
    """
    def value(p: Column) -> Column:
        found = F.when(p["own"], F.element_at(attributes, p["column"])).otherwise(
            F.element_at(looked_up, p["column"])
        )
        return F.coalesce(p["text"], resolved(found))

    return F.transform(parts, lambda p: F.struct(p["name"].alias("name"), value(p).alias("value")))


def text_of(filled: Column) -> Column:
    return F.array_join(F.transform(filled, lambda p: p["value"]), "")


def options(text: Column) -> Column:
    return F.split(text, r"\|")


def option_index(n_parts: Column, test_key: Column, seed: Column) -> Column:
    """Rotating option number; 0 while there is nothing to rotate."""
    n = n_parts - 1
    # greatest() keeps the divisor positive for the rows the WHEN does not use
    return F.when(n_parts > 2, (test_key + seed % F.greatest(n, F.lit(1))) % F.greatest(n, F.lit(1))).otherwise(
        F.lit(0)
    )


def choose(parts: Column, test_key: Column, seed: Column, is_subject: Column) -> Column:
    """Option shown today: default part alone only for the subject line, else `None`."""
    n = F.size(parts)
    alone = F.when(is_subject, F.get(parts, F.lit(0))).otherwise(F.lit(DEFAULT_TEXT))
    return F.when(n <= 1, alone).otherwise(F.get(parts, option_index(n, test_key, seed) + 1))


def is_unresolved(value: Column, legacy_null_words: bool = False) -> Column:
    """Missing look-up, the word none, or nan/null.

    nan and null count as whole words; `legacy_null_words` also finds them inside words.
    """
    low = F.lower(value)
    words = (
        low.contains("nan") | low.contains("null")
        if legacy_null_words
        else low.rlike(r"\b(nan|null)\b")
    )
    return low.contains(NOT_FOUND) | (low == "none") | words


def is_attribute(value: Column) -> Column:
    """Values worth reporting as dynamic content."""
    return value.isNotNull() & ~F.lower(value).isin(NOT_FOUND, "nan", "none")
