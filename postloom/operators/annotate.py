"""Labelling posts with a user-supplied model inside Spark tasks."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A labeller maps a list of texts to as many JSON strings. The factory builds one per worker task.
Labeller = Callable[[list[str]], list[str]]
LabellerFactory = Callable[[], Labeller]

# Rows that a task turns into Python strings at a time, about: what it holds does not follow its input.
ROWS = 256


def _ask(labeller: Labeller, texts: list[str], tries: int, wait: float) -> list[tuple[str | None, str | None]]:
    """(response, error) per text; a failing group of texts is asked again one by one before it is given up."""
    error = ""
    for attempt in range(tries):
        try:
            answers = labeller(texts)
            if len(answers) != len(texts):
                raise ValueError("the labeller must return one answer per text")
            for answer in answers:
                if not answer:
                    raise ValueError("empty answer")
                json.loads(answer)
            return [(a, None) for a in answers]
        except json.JSONDecodeError:
            error, pause = f"answer is not JSON after {tries} tries", wait
        except Exception as exc:
            error, pause = str(exc) or type(exc).__name__, wait * (attempt + 1)
        if attempt + 1 < tries:
            time.sleep(pause)
    if len(texts) > 1:
        return [pair for text in texts for pair in _ask(labeller, [text], tries, wait)]
    return [(None, error)]


def annotate(
    posts: DataFrame,
    factory: LabellerFactory,
    *,
    text_col: str = "full_text",
    batch_size: int = 1,
    concurrency: int | None = None,
    tries: int = 3,
    retry_wait: float = 2.0,
    call_pause: float = 0.1,
) -> DataFrame:
    """Add ``response`` and ``call_error``; exactly one of them is null.

    ``concurrency`` fixes the number of tasks, hence of parallel callers. A retried task asks again, so write the result
    before using it twice (``plans.enrich_job`` does, chunk by chunk).
    """
    schema = T.StructType(
        [*posts.schema.fields, T.StructField("response", T.StringType()), T.StructField("call_error", T.StringType())]
    )
    group = -(-ROWS // batch_size) * batch_size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = factory()
        for batch in batches:
            for at in range(0, batch.num_rows, group):
                rows = batch.slice(at, group)
                answers: list[tuple[str | None, str | None]] = []
                texts = rows.column(text_col).to_pylist()
                for start in range(0, len(texts), batch_size):
                    answers += _ask(labeller, texts[start : start + batch_size], tries, retry_wait)
                    if call_pause:
                        time.sleep(call_pause)
                for name, values in zip(("response", "call_error"), zip(*answers)):
                    rows = rows.append_column(name, pa.array(values, pa.string()))
                yield rows

    return (posts.repartition(concurrency) if concurrency else posts).mapInArrow(run, schema)


def chunk_of(id_col: str, chunks: int):
    """Stable chunk number of an id: an interrupted run finds the same chunks again."""
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(chunks)).cast("int")
