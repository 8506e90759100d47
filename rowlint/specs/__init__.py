"""Bundled example specs (YAML), loadable with ``spec_path(name)``."""

import os

HERE = os.path.dirname(__file__)


def spec_path(name: str) -> str:
    """Path of a bundled spec, e.g. ``spec_path("customers_complex")``."""
    return os.path.join(HERE, name if name.endswith(".yaml") else name + ".yaml")


# Column metadata of the customer sample (catalog-shaped; fixed values).
METADATA_SCHEMA = (
    "ordinal long, column string, type string, nullable boolean, length int, "
    "constraints struct<regex: string, min: double, max: double, enum: array<string>>"
)


def metadata_rows(name: str = "customers_metadata") -> list[dict]:
    import json

    with open(os.path.join(HERE, name + ".json"), encoding="utf-8") as f:
        rows = json.load(f)
    for r in rows:
        c = r.get("constraints") or {}
        r["constraints"] = {k: c.get(k) for k in ("regex", "min", "max", "enum")}
        for k in ("min", "max"):
            if r["constraints"][k] is not None:
                r["constraints"][k] = float(r["constraints"][k])
    return rows


def metadata_frame(spark, name: str = "customers_metadata"):
    """The metadata as a DataFrame, the input of ``operators.suite``."""
    return spark.createDataFrame(metadata_rows(name), METADATA_SCHEMA)
