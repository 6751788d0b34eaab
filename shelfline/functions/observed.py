"""Reading observed metrics."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.sql import Observation


def seen_by(observation: Observation) -> dict | None:
    """Metrics of a finished observation; None where the optimizer removed the observed plan, as it does
    with an input that it knows to be empty."""
    try:
        return observation.get
    except Py4JError:
        return None
