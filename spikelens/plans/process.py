"""The whole batch job: raw log rows in; rejects, responses, audit rows and alerts out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from spikelens.operators import hot as H
from spikelens.operators.dedup import first_wins
from spikelens.operators.hot import hot_keys
from spikelens.operators.parse import lean, parse_events, rejects, valid_events
from spikelens.operators.projections import to_alerts, to_audit, to_responses
from spikelens.operators.surge import surge_scores
from spikelens.params import EngineParams
from spikelens.sources.tables import stage

# A user's events share a partition, where the offset orders them; the partition makes the order
# total for keys that arrive on several.
ARRIVAL = ("offset", "partition")


@dataclass(frozen=True)
class Outcome:
    """Lazy results of one run. Persist or write ``scored`` when several of them are used.

    ``parsed`` are the typed rows of the log as they were staged, for a replay of the same log.
    """

    scored: DataFrame
    rejects: DataFrame
    ingested_at: Column | None = None
    parsed: DataFrame | None = None

    @property
    def audit(self) -> DataFrame:
        return to_audit(self.scored, self.ingested_at)

    @property
    def alerts(self) -> DataFrame:
        return to_alerts(self.scored)

    @property
    def responses(self) -> DataFrame:
        return to_responses(self.scored)


def score_log(
    valid: DataFrame,
    params: EngineParams = EngineParams(),
    stored: DataFrame | None = None,
    start: DataFrame | None = None,
    order: tuple = ARRIVAL,
    hot_limit: int = H.HOT_ROWS,
    chunk_rows: int = H.CHUNK_ROWS,
    idle_reset: float | None = None,
    touched: str = "arrived_at",
) -> DataFrame:
    """De-duplicate, then score: one shuffle by key, one by user.

    Duplicates are scored against the window of the moment but neither enter it nor alert.
    ``stored`` holds the keys persisted earlier, ``start`` the windows left by earlier runs.
    With ``idle_reset`` seconds a window is forgotten when the column ``touched``, which says when an
    event was handled, shows such a gap; duplicates keep a window alive as well.
    """
    # Columns that no result needs must not travel through the shuffles and the Arrow pass.
    slim = valid.drop("topic", "key")
    hot = hot_keys(slim, "user_id", hot_limit)
    flagged = first_wins(slim, order=order, stored=stored, hot_limit=hot_limit)
    return surge_scores(
        flagged,
        order=order,
        params=params,
        inserted="inserted",
        start=start,
        hot=hot,
        chunk_rows=chunk_rows,
        idle_reset=idle_reset,
        touched=touched,
    )


def process(
    raw: DataFrame,
    default_ts: str | Column | None = None,
    ingested_at: Column | None = None,
    parsed: DataFrame | None = None,
    **scoring,
) -> Outcome:
    """Parse once, stage the typed rows, score the valid ones.

    Parsing costs far more than reading typed columns back, and the counts of frequent keys, the
    scores and the rejects all start from it. A replay of the very same log takes the typed rows of
    its first run, ``parsed``: a row's parse depends on the row alone, given a stored ``default_ts``.
    """
    if parsed is None:
        parsed = stage(lean(parse_events(raw, default_ts)), "parsed")
    return Outcome(score_log(valid_events(parsed), **scoring), rejects(parsed), ingested_at, parsed)
