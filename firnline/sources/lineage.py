"""Lineage edges from product metadata documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.functions.times import parse_time
from firnline.scale import python_partitions

# fixed values: element names of the metadata documents
_INNER = (
    "struct<`gmd:fileIdentifier`: struct<`gco:CharacterString`: string>,"
    " `gmd:identificationInfo`: struct<`gmd:MD_DataIdentification`: struct<`gmd:extent`:"
    " struct<`gmd:EX_Extent`: struct<`gmd:temporalElement`: struct<`gmd:EX_TemporalExtent`:"
    " struct<`gmd:extent`: struct<`gml:TimePeriod`:"
    " struct<`gml:beginPosition`: string, `gml:endPosition`: string>>>>>>>>>"
)
_SCHEMA = (
    "struct<`gmd:series`: struct<`gmd:DS_OtherAggregate`: struct<`gmd:seriesMetadata`:"
    f" array<struct<`gmd:MD_Metadata`: {_INNER}>>>>,"
    " `gmd:identificationInfo`: struct<`gmd:MD_DataIdentification`: struct<`gmd:extent`:"
    " struct<`gmd:EX_Extent`: struct<`gmd:temporalElement`: struct<`gmd:EX_TemporalExtent`:"
    " struct<`gmd:extent`: struct<`gml:TimePeriod`:"
    " struct<`gml:beginPosition`: string, `gml:endPosition`: string>>>>>>>>>"
)
_PERIOD = (
    "`gmd:identificationInfo`.`gmd:MD_DataIdentification`.`gmd:extent`.`gmd:EX_Extent`"
    ".`gmd:temporalElement`.`gmd:EX_TemporalExtent`.`gmd:extent`.`gml:TimePeriod`"
)


def _parsed(docs: DataFrame, product: str, xml: str) -> DataFrame:
    """Documents parsed; spread first, because a file of one row group would be one
    task for work that is heavy per row."""
    spread = docs.select(product, xml).repartition(python_partitions(docs), product)
    return spread.select(product, F.from_xml(F.col(xml), _SCHEMA).alias("d"))


def lineage_from_metadata(docs: DataFrame, product: str = "product_id", xml: str = "xml") -> DataFrame:
    """Edges ``product, input_id, begin, end`` for aggregated products.

    The series is declared as an array, so one or many inputs read alike.
    """
    parsed = _parsed(docs, product, xml)
    # the outer form infers no filter, which would parse every document again
    item = parsed.select(
        product, F.explode_outer("d.`gmd:series`.`gmd:DS_OtherAggregate`.`gmd:seriesMetadata`").alias("s")
    ).select(product, F.col("s.`gmd:MD_Metadata`").alias("m"))
    return item.where(F.col("m").isNotNull()).select(
        product,
        F.col("m.`gmd:fileIdentifier`.`gco:CharacterString`").alias("input_id"),
        parse_time(F.col(f"m.{_PERIOD}.`gml:beginPosition`")).alias("begin"),
        parse_time(F.col(f"m.{_PERIOD}.`gml:endPosition`")).alias("end"),
    )


def own_period(docs: DataFrame, product: str = "product_id", xml: str = "xml") -> DataFrame:
    """Each product's own time span, as an edge to itself."""
    parsed = _parsed(docs, product, xml)
    return parsed.select(
        product,
        F.col(product).alias("input_id"),
        parse_time(F.col(f"d.{_PERIOD}.`gml:beginPosition`")).alias("begin"),
        parse_time(F.col(f"d.{_PERIOD}.`gml:endPosition`")).alias("end"),
    )
