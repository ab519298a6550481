"""Picking figures from a company-facts body.

The schema lists only the tags that are read, so the parser skips every other tag and one
pass over the body is enough. No shuffle: each company's facts stand in one row. A body can also be
kept as a VARIANT, parsed as it lands; weekly runs then look tags up instead of parsing text again.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from greenshoe import fixed_values as V
from greenshoe.functions.dialect import json_object, let, whole_number
from greenshoe.schemas import FACT


def _tags(names: list[str], unit: str) -> T.StructType:
    units = T.StructType([T.StructField(unit, T.ArrayType(FACT))])
    body = T.StructType([T.StructField("units", units)])
    return T.StructType([T.StructField(name, body) for name in names])


def _body_schema() -> T.StructType:
    spaces = []
    for space in V.SHARE_COUNT_NAMESPACES:
        fields = list(_tags(V.SHARE_COUNT_TAGS, "shares").fields)
        if space == "us-gaap":
            fields = list(_tags(V.REVENUE_TAGS, "USD").fields) + fields
        spaces.append(T.StructField(space, T.StructType(fields)))
    return T.StructType([T.StructField("facts", T.StructType(spaces))])


def parse_facts(body: Column) -> Column:
    return json_object(body, _body_schema())["facts"]


def facts_variant(body: Column) -> Column:
    """A body as a VARIANT, parsed once for all later reads; NULL where it is no JSON object.

    It holds every tag, so tags that are wanted later need no new parse of the text.
    """
    is_object = F.rtrim(body, F.lit(" \n\r\t")).endswith("}")
    return F.when(is_object, F.try_parse_json(body))


def read_facts(parsed: Column) -> Column:
    """The same as ``parse_facts``, from a VARIANT: only the tags that are used are looked up.

    One difference: what is no object in a list of facts is passed over, where ``parse_facts``
    skips the body.
    """
    return F.try_variant_get(parsed, "$", _ddl(_body_schema()))["facts"]


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        fields = ", ".join(f"`{f.name}`: {_ddl(f.dataType)}" for f in kind.fields)
        return f"STRUCT<{fields}>"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_ddl(kind.elementType)}>"
    return kind.simpleString()


def _series(facts: Column, space: str, tag: str, unit: str) -> Column:
    return facts[space][tag]["units"][unit]


def _latest(series: Column) -> Column:
    """The fact with the largest ``end``; the first one wins a tie, a missing ``end`` is ''."""
    ranked = F.transform(
        series,
        lambda fact, i: F.struct(
            F.coalesce(fact["end"], F.lit("")).alias("rank_end"),
            (-i).alias("rank_position"),
            fact.alias("fact"),
        ),
    )
    return F.array_max(ranked)["fact"]


def _is_annual(fact: Column) -> Column:
    return fact["fp"] == V.ANNUAL_PERIOD


def trailing_revenue(facts: Column) -> Column:
    """``struct(tag, value)`` of the first tag with an annual-report fact."""

    def of_tag(tag: str) -> Column:
        annual = F.filter(
            _series(facts, "us-gaap", tag, "USD"),
            lambda fact: fact["form"].startswith(V.ANNUAL_FORM_PREFIX) & _is_annual(fact),
        )
        return let(
            _latest(annual),
            lambda fact: F.when(
                fact.isNotNull(),
                F.struct(F.lit(tag).alias("tag"), fact["val"].try_cast("double").alias("value")),
            ),
        )

    return F.coalesce(*[of_tag(tag) for tag in V.REVENUE_TAGS])


def shares_outstanding(facts: Column) -> Column:
    """``struct(value)`` of the first tag and namespace that has any fact, whatever its form."""

    def of_tag(tag: str, space: str) -> Column:
        return let(
            _latest(_series(facts, space, tag, "shares")),
            lambda fact: F.when(fact.isNotNull(), F.struct(whole_number(fact["val"]).alias("value"))),
        )

    return F.coalesce(
        *[of_tag(tag, space) for tag in V.SHARE_COUNT_TAGS for space in V.SHARE_COUNT_NAMESPACES]
    )


def fiscal_year_end(facts: Column) -> Column:
    """``struct(value)``: the end of the latest full-year fact of one tag, whatever its form."""
    annual = F.filter(_series(facts, "us-gaap", V.FISCAL_YEAR_TAG, "USD"), _is_annual)
    return let(
        _latest(annual),
        lambda fact: F.when(fact.isNotNull(), F.struct(fact["end"].alias("value"))),
    )
