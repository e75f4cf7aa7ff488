"""Quality report over the layers of a medallion."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lakestrata import constants as const
from lakestrata.operators.quality import LayerChecks, check_layer, quality_report
from lakestrata.plans.batch import Medallion
from lakestrata.sources.storage import file_info
from lakestrata.sources.versioned import VersionedTable


def open_layer(spark: SparkSession, path: str) -> DataFrame:
    """A layer of a medallion, a versioned table if the folder has commits, plain Parquet otherwise."""
    root, _, layer = path.rstrip("/").rpartition("/")
    if layer in const.LAYERS and file_info(spark, f"{root}/manifest") is not None:
        return getattr(Medallion(spark, root), layer).read()
    table = VersionedTable(spark, path)
    return table.read() if table.latest_version() >= 0 else spark.read.parquet(path)


def check_layers(
    spark: SparkSession, paths: Mapping[str, str], as_of: str | None = None
) -> list[LayerChecks]:
    return [check_layer(spark, path, layer, open_layer, as_of) for layer, path in paths.items()]


def layer_paths(root: str) -> dict[str, str]:
    return {layer: f"{root.rstrip('/')}/{layer}" for layer in const.LAYERS}


def layer_report(spark: SparkSession, root: str, as_of: str | None = None) -> DataFrame:
    """The nested report over all layers below ``root``."""
    return quality_report(check_layers(spark, layer_paths(root), as_of))
