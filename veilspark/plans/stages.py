"""Public composition API: custom stages (U1), sources (U2), verified stages (U3), pipelines (U4).

A *stage* is a plain function ``DataFrame -> DataFrame``; a pipeline is a
list of stages applied with ``DataFrame.transform``, so the whole chain stays
one logical plan for Catalyst.  A *source* is any DataFrame (``spark.read``
or ``spark.readStream``); ``veilspark.sources.custom`` makes one of your own.  Opaque
per-partition code goes through ``pandas_stage`` or, if it has something to
open and close, through an ``ArrowStage`` (Arrow batches, never row-at-a-time).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from veilspark.functions.text import tokenize
from veilspark.operators.bounding import apply_privacy_level
from veilspark.operators.integrity import verified_stage
from veilspark.params import PrivacyParams
from veilspark.plans.histogram import HistogramResult, private_histogram

Stage = Callable[[DataFrame], DataFrame]


def run_stages(df: DataFrame, stages: Iterable[Stage]) -> DataFrame:
    """Apply stages in order (each one a ``df.transform``)."""
    return reduce(lambda acc, st: acc.transform(st), stages, df)


def pandas_stage(fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> Stage:
    """U1 for opaque code: ``mapInPandas`` over Arrow batches of each partition."""
    return lambda df: df.mapInPandas(fn, schema)


class ArrowStage:
    """U1 with a life in every task: subclass it and give ``schema``, ``process`` and, if wanted, ``open`` and ``close``.

    ``open`` runs in the task before its first batch and gives a handle;
    ``process`` turns a batch into any number of batches; ``flush`` may give
    more after the last one; ``close`` runs at the end of the task, also when
    ``process`` fails or nobody asks for the rest.  An instance is a stage.  It
    is pickled to the tasks, so what can't be pickled belongs into ``open``.
    """

    schema: str = ""

    def open(self) -> Any:
        return None

    def process(self, handle: Any, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError

    def flush(self, handle: Any) -> Iterator[pa.RecordBatch]:
        return iter(())

    def close(self, handle: Any) -> None:
        pass

    def __call__(self, df: DataFrame) -> DataFrame:
        def run(batches):
            handle = self.open()
            try:
                for batch in batches:
                    yield from self.process(handle, batch)
                yield from self.flush(handle)
            finally:
                self.close(handle)

        return df.mapInArrow(run, self.schema)


def tokenize_stage(text: str, keep: Sequence[str]) -> Stage:
    return lambda df: tokenize(df, text, keep=list(keep))


def bounding_stage(params: PrivacyParams, user: str, order_by: Sequence) -> Stage:
    return lambda df: apply_privacy_level(df, params, user, order_by)


def verified(stage: str, source: str, destination: str, producer: str, seq: str, order_by: Sequence,
             check_routes: bool = True, check_replay: bool = True, **more) -> Stage:
    """U3 as a stage: all checks of ``verified_stage`` (which takes ``more``), failing the job on a violation."""
    return lambda df: verified_stage(df, stage, source, destination, producer, seq, order_by, policy="fail",
                                     check_routes=check_routes, check_replay=check_replay, **more)


def word_histogram(df: DataFrame, text: str, user: str, trigger: str, order_by: Sequence, params: PrivacyParams,
                   secret: bytes | str, stream_id: str) -> HistogramResult:
    """U4: the word-count application: tokenize -> bound -> count per trigger -> DP release."""
    toks = tokenize(df, text, keep=[c for c in df.columns if c != text])
    return private_histogram(toks, "word", trigger, user, [*order_by, "pos"], params, secret, stream_id)


def stream_word_histogram(stream: DataFrame, text: str, user: str, order_by: Sequence[str], params: PrivacyParams,
                          secret: bytes | str, stream_id: str, counts_path: str, snapshots_path: str,
                          checkpoint: str, runs: int = 1, processing_time: str | None = None,
                          trigger: str = "micro-batch") -> None:
    """U4 on a stream: tokenize -> per-user bound (keyed state) -> one trigger per non-empty micro-batch ->
    DP release written as a ranked snapshot per batch (W1 -> W3/W5 -> S5).

    ``order_by`` is the arrival order of the records; tokens follow it by
    position.  ``processing_time`` sets the snapshot tick; without it the
    stream runs availableNow ``runs`` times from ``checkpoint``.  ``trigger``
    names the trigger that the noise is bound to.
    """
    from veilspark.streaming.bounding import stream_bound_contributions
    from veilspark.streaming.release import StreamRelease
    from veilspark.streaming.run import run_foreach_batch

    toks = tokenize(stream, text, keep=[c for c in stream.columns if c != text])
    order = [*order_by, "pos"]
    bounded = stream_bound_contributions(toks, user, order, params.max_contributions) if params.user_level else toks
    release = StreamRelease(counts_path, snapshots_path, "word", params, secret, stream_id, trigger)
    run_foreach_batch(bounded, release, "word-histogram", checkpoint=checkpoint, processing_time=processing_time,
                      runs=runs)
