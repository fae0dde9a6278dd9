"""When requests may be sent under a limit of their rate, as a parallel computation.

Of a model's requests in the order of their arrival, the i-th may be sent when
it has arrived and the one `limit` places before it is `seconds` old:
t(i) = max(arrival(i), t(i - limit) + seconds).  Requests whose numbers leave the
same rest by the limit only wait for each other, so with k = i div limit
t(i) - k * seconds is the greatest of arrival(j) - (j div limit) * seconds over
the class up to i, which is a running maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import ranged, running


def rate_limited(requests: DataFrame, limit: Column, seconds: int = 60, model: str = "model", arrival: str = "arrival_us", tie: str = "event_id") -> DataFrame:
    """requests with number (from 0, of its model, by arrival and tie), submit_us and wait_us.

    limit is how many of the model's requests may be sent in any `seconds`; it
    has to be the same for all rows of a model.  Where it is null or 0 there is
    none, and nothing waits.  A null arrival comes first and counts as the start
    of time (0).  Numbers come from counts of ranges and the maxima from ranges'
    maxima, so no task holds a model.
    """
    width = seconds * 1_000_000
    rows = requests.withColumn("_limit", F.greatest(F.coalesce(limit, F.lit(0)), F.lit(0)).cast("long")).withColumn("_at", F.coalesce(F.col(arrival), F.lit(0))).withColumn("_one", F.lit(1).cast("long"))
    rows = ranged(rows, [F.col(model), F.col("_at"), F.col(tie)])
    rows = running(rows, [model], F.col("_part"), ["_at", tie], "_one", "number").withColumn("number", F.col("number") - 1)
    by = F.greatest(F.col("_limit"), F.lit(1))
    rows = rows.withColumn("_turn", F.floor(F.col("number") / by)).withColumn("_class", F.col("number") % by).withColumn("_slack", F.col("_at") - F.col("_turn") * width)
    free = rows.where("_limit = 0").withColumn("submit_us", F.col("_at"))
    bound = running(rows.where("_limit > 0"), [model, "_class"], F.col("_part"), ["_turn"], "_slack", "_latest", F.max).withColumn("submit_us", F.col("_latest") + F.col("_turn") * width).drop("_latest")
    found = bound.unionByName(free)
    return found.select(*requests.columns, "number", "submit_us", (F.col("submit_us") - F.col("_at")).alias("wait_us"))
