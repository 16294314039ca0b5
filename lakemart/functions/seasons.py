"""Start season of studies, deadlines and report seasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.functions.keys import as_col
from lakemart.functions.times import add_days, seconds_of_day

# fixed values of the documents
BY_SEASON = "alkamiskausi ja -vuosi"
BY_DATE = "tarkka alkamisajankohta"
SPRING = "kausi_k#1"
AUTUMN = "kausi_s#1"
FIRST_AUTUMN_MONTH = 8

START_FIELDS = (
    "alkamiskausityyppi string, koulutuksenAlkamisvuosi string, "
    "koulutuksenAlkamiskausiKoodiUri string, koulutuksenAlkamispaivamaara string"
)


def start_of(document: Column | str) -> Column:
    """Year and season of a start document as ``struct<type, year, season>``.

    ``type`` is 'kausivuosi' for a known year, 'henkkoht' for a personal plan
    and NULL where the year is left open; the struct is NULL without a document.
    """
    document = as_col(document)
    d = F.from_json(document, START_FIELDS)
    kind, day = d["alkamiskausityyppi"], F.to_timestamp(d["koulutuksenAlkamispaivamaara"])
    year = F.when(kind == BY_SEASON, d["koulutuksenAlkamisvuosi"].cast("int")).when(kind == BY_DATE, F.year(day))
    by_date = F.when(F.month(day) < FIRST_AUTUMN_MONTH, SPRING).otherwise(AUTUMN)
    season = F.when(kind == BY_SEASON, d["koulutuksenAlkamiskausiKoodiUri"]).when(kind == BY_DATE, by_date)
    known = F.coalesce(kind.isin(BY_SEASON, BY_DATE), F.lit(False))
    type_ = F.when(~known | (year == -1), "henkkoht").when(year.isNotNull(), "kausivuosi")
    return F.when(document.isNotNull(), F.struct(type_.alias("type"), year.alias("year"), season.alias("season")))


def start_json(document: Column | str) -> Column:
    """The same as a JSON object; ``{}`` where the year is left open."""
    start = start_of(document)
    dated = F.to_json(
        F.struct(
            start["type"].alias("type"),
            start["year"].alias("koulutuksenAlkamisvuosi"),
            start["season"].alias("koulutuksenAlkamiskausiKoodiUri"),
        ),
        {"ignoreNullFields": "false"},
    )
    return (
        F.when(start["type"] == "henkkoht", F.lit('{"type":"henkkoht"}'))
        .when(start["type"] == "kausivuosi", dated)
        .when(start.isNotNull(), F.lit("{}"))
    )


def acceptance_deadline(published: Column, personal_days: Column, common_deadline: Column) -> Column:
    """Last moment to accept a study place.

    The later of the common deadline and publication plus the personal days;
    it falls on that day at the common deadline's time of day, or on the next
    day if that time has passed already.
    """
    latest = F.date_trunc("minute", F.greatest(common_deadline, add_days(published, personal_days)))
    same_day = F.make_timestamp(
        F.year(latest), F.month(latest), F.dayofmonth(latest), F.hour(common_deadline), F.minute(common_deadline),
        F.lit(0).cast("decimal(8,6)"),
    )
    late = seconds_of_day(common_deadline) < seconds_of_day(latest)
    return add_days(same_day, F.when(late, 1).otherwise(0))
