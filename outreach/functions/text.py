"""String expressions: program parts, ids, join specs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def is_present(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def program_part(program_type: Column, i: int) -> Column:
    """Part `i` of a dotted program code, runs of dots counting as one; NULL past the end."""
    return F.get(F.split(program_type, r"\.+"), F.lit(i))


def pad_id(row_id: Column) -> Column:
    """Zero-pad to nine characters; longer ids keep all their digits."""
    text = row_id.cast("string")
    return F.when(F.length(text) >= 9, text).otherwise(F.lpad(text, 9, "0"))


def key_id(sid: Column, row_id: Column) -> Column:
    return F.concat(sid.cast("string"), pad_id(row_id))


def loyalty_flag(status: Column) -> Column:
    """'1' for an active member, '0' for anything else, NULL included."""
    return F.when(status == "Active", F.lit("1")).otherwise(F.lit("0"))


def spec_side(spec: Column, side: int) -> Column:
    """Columns of one side (1 left, 2 right) of a join spec `t.a;t.b|f.c;f.d`."""
    part = F.split_part(spec, F.lit("|"), F.lit(side))
    names = F.transform(F.split(part, ";"), lambda x: F.get(F.split(x, r"\."), F.lit(1)))
    return F.filter(names, lambda x: x.isNotNull())


def spec_file(spec: Column) -> Column:
    """Look-up table named by the right side of a join spec; NULL when there is none."""
    right = F.split_part(spec, F.lit("|"), F.lit(2))
    return F.nullif(F.split_part(right, F.lit("."), F.lit(1)), F.lit(""))


def template_tokens(template: Column) -> Column:
    """Text between each closed pair of %% markers, in order."""
    parts = F.split(template, "%%")
    closed = F.transform(
        parts, lambda p, i: F.when((i % 2 == 1) & (i < F.size(parts) - 1), p)
    )
    return F.filter(closed, lambda p: p.isNotNull())


def token_table(token: Column) -> Column:
    return F.get(F.split(token, r"\."), F.lit(0))


def token_column(token: Column) -> Column:
    return F.get(F.split(token, r"\."), F.lit(1))


def spec_columns(template: Column) -> Column:
    """Sorted look-up columns a template reads (everything not read from the traveler)."""
    other = F.filter(template_tokens(template), lambda t: token_table(t) != "traveler")
    return F.array_sort(F.array_distinct(F.transform(other, token_column)))


def traveler_columns(template: Column) -> Column:
    """Sorted traveler columns a template reads."""
    own = F.filter(template_tokens(template), lambda t: token_table(t) == "traveler")
    return F.array_sort(F.array_distinct(F.transform(own, token_column)))


def display_locale(locale: Column) -> Column:
    """A locale in delivered spelling: `en_us` becomes `en_US`."""
    parts = F.split(locale, "_", 2)
    return F.when(locale.isNotNull(), F.concat_ws("_", F.lower(parts[0]), F.upper(F.get(parts, F.lit(1)))))


def output_name(audience: Column, run_date: Column, job_type: str, test_type: str | None) -> Column:
    """Audience name with the suffix of the run mode."""
    if job_type != "test":
        return audience
    if test_type == "MANUAL":
        return F.concat(audience, F.lit("_MTS"))
    if test_type == "AUTOTEST":
        return F.concat(audience, F.lit("_ATS"))
    if test_type == "BACKUP":
        return F.concat(audience, F.lit("_BACKUP_"), F.date_format(run_date, "yyyyMMdd"))
    return F.concat(audience, F.lit(f"_{test_type}"))


def recipient_id(
    brand: Column,
    site: Column,
    parts: list[Column],
    issue: Column,
    sid: Column,
    key: Column,
    account: Column,
    locale: Column,
    opted_in: Column,
    module_code: Column,
    home_brand: str,
) -> Column:
    """Tracking id of one message. A NULL component gives a NULL id."""
    prefix = F.when(brand == home_brand, F.lit("")).otherwise(F.concat(brand, F.lit("-")))
    letter = F.when(F.trim(opted_in.cast("string")).isin("1", "Y"), "M").otherwise("C")
    return F.concat(
        prefix,
        F.trim(site),
        *[piece for p in parts for piece in (F.lit("."), p)],
        F.lit("&EMLDTL=DATE"), issue,
        F.lit(".SID"), sid.cast("string"),
        F.lit(".KEY"), key,
        F.lit(".PAID"), F.trim(account.cast("string")),
        F.lit(".LANG"), F.upper(locale),
        F.lit(".MCID"), letter,
        F.lit(".TEST1.VERSX.MIDS"), module_code,
    )


def rewrite_tag(recipient: Column, tag: Column) -> Column:
    """Put `test#arm` in place of the default tag; a NULL id stays NULL."""
    pieces = F.split(tag, "#")
    return F.replace(
        recipient,
        F.lit("TEST1.VERSX"),
        F.concat(F.lit("TEST"), F.get(pieces, F.lit(0)), F.lit(".VERS"), F.get(pieces, F.lit(1))),
    )
