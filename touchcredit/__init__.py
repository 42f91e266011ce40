"""touchcredit — customer-journey and marketing-attribution analytics on Spark.

Every model is a pure ``DataFrame -> DataFrame`` function built from native
Spark joins, aggregations and windows:

* ``plans.identity``     unify customer identities across five systems (M1)
* ``plans.touchpoints``  normalise four touch feeds with resolved identity (M2)
* ``plans.conversions``  orders -> conversions with a repeat-purchase flag (M3)
* ``plans.costs``        daily ad spend from two cost feeds (M4)
* ``plans.journeys``     stitch touches to the orders they precede (M5)
* ``plans.marts``        first / last / linear / time-decay attribution (M6-M9)
* ``plans.quality``      declarative not_null / unique / accepted_values /
                         relationships checks (M10)

``plans.pipeline.AttributionPipeline`` wires them together and materialises the
fan-out points (profiles, touchpoints, journeys) once.
"""

from touchcredit.plans.pipeline import AttributionPipeline  # noqa: F401
from touchcredit.sources.fixtures import load_fixture_sources  # noqa: F401
from touchcredit.sources.readers import RawSources  # noqa: F401
