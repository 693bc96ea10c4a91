"""Tierline: landing, raw and bronze layers as Spark DataFrame and Structured Streaming operators."""

from tierline import sources, streaming
from tierline.functions import derive, payload, schema
from tierline.operators import fixtures, inspect, ledger, sinks
from tierline.plans import jobs
from tierline.sources import evolve
from tierline.spec import BronzeSpec, DatasetSpec, Field, Layers, from_json, load_config, specs_from_config

__all__ = [
    "BronzeSpec", "DatasetSpec", "Field", "Layers", "derive", "evolve", "fixtures", "from_json", "inspect", "jobs",
    "ledger", "load_config", "payload", "schema", "sinks", "sources", "specs_from_config", "streaming",
]
