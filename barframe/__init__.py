"""barframe — Spark-native operators for daily market bars.

Every public operator is a pure ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from Spark SQL expressions: no actions inside, no session creation,
no Python UDFs. Sub-packages:

* ``barframe.schema``     — the canonical bar schema and column checks
* ``barframe.functions``  — column expressions (safe division, calendar, noise, path parsing)
* ``barframe.sources``    — readers, writers and the stand-in bar fixtures
* ``barframe.operators``  — cleaning, enrichment, aggregation, windows, multiplication, modelling
* ``barframe.plans``      — whole jobs composed from operators, plus the shared work folder
* ``barframe.streaming``  — the same clean/enrich/aggregate plan over a file stream
"""

from barframe.schema import BAR_SCHEMA, BAR_COLUMNS, require_columns, has_columns  # noqa: F401

__version__ = "0.1.0"
