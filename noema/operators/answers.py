"""L2 answer store: model answers kept by prompt key, filled in micro-batches.

``AnswerStore`` stands in for a generator wherever one is taken.  New prompts are written to the
store's inbox, and a resumable query (S9) asks them a micro-batch at a time: the answers
of a batch are written before the next is asked, and the keys of answered prompts are in
the query's state.  So a failure costs at most the answers of the unfinished batch, and a
prompt that was answered is not asked again, by this call or a later one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from noema.session import path_exists
from noema.streaming.resume import results, run_resumable

Generator = Callable[[list[str], list[str]], list[str]]
PROMPTS = "prompt_key string, system string, user string"
ANSWERS = "prompt_key string, raw string"


def ask(prompts: DataFrame, generator: Generator) -> DataFrame:
    """``(prompt_key, system, user)`` → ``(prompt_key, raw)``, the generator called once for each Arrow batch."""
    def run(batches):
        for pdf in batches:
            raws = generator(pdf["system"].tolist(), pdf["user"].tolist())
            yield pd.DataFrame({"prompt_key": pdf["prompt_key"],
                                "raw": [("" if r is None else str(r)).strip() for r in raws]})
    return prompts.mapInPandas(run, ANSWERS)


@dataclass(frozen=True)
class AnswerStore:
    """Answers of ``generator`` under ``path``, a shared folder with one writer at a time.

    ``prompts_per_file`` times ``files_per_batch`` prompts are asked in a micro-batch; its
    files are as many tasks."""
    path: str
    generator: Generator
    prompts_per_file: int = 2_000
    files_per_batch: int = 32

    def answers(self, spark) -> DataFrame:
        return results(spark, f"{self.path}/answers", ANSWERS)

    def ask(self, prompts: DataFrame) -> DataFrame:
        """``(prompt_key, raw)`` for distinct ``prompts``: the kept answers, the missing ones
        asked first.  A call that failed is taken up by the next one."""
        spark = prompts.sparkSession
        inbox, kept = f"{self.path}/inbox", f"{self.path}/answers"
        todo = prompts.select("prompt_key", "system", "user")
        if path_exists(spark, kept):
            todo = todo.join(self.answers(spark).select("prompt_key"), "prompt_key", "left_anti")
        todo.write.option("maxRecordsPerFile", self.prompts_per_file).mode("append").parquet(inbox)
        run_resumable(spark, inbox, PROMPTS, "prompt_key", lambda rows: ask(rows, self.generator), kept,
                      f"{self.path}/progress", max_files_per_trigger=self.files_per_batch)
        return prompts.select("prompt_key").join(self.answers(spark), "prompt_key")

