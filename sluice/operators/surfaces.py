"""Extension points: validators, embedders, generators, and the registry of sources."""

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import enhanced_prompt, numbered_name
from sluice.operators.quality import cascade


class Validator(Protocol):
    """A named row predicate with side scores. Native ones cost nothing where an earlier one has failed."""

    name: str

    def check(self) -> tuple[Column, dict[str, Column]]: ...


class ExpressionValidator:
    def __init__(self, name: str, passes: Callable[[], Column], scores: Callable[[], dict[str, Column]] = dict):
        self.name, self._passes, self._scores = name, passes, scores

    def check(self) -> tuple[Column, dict[str, Column]]:
        return self._passes(), self._scores()


def validate(df: DataFrame, validators: Sequence[Validator]) -> DataFrame:
    """The rows with failed_check, the scores that were reached, and valid."""
    return cascade(df, [(v.name, *v.check()) for v in validators]).withColumn("valid", F.col("failed_check").isNull())


def embed(df: DataFrame, column: str, load: Callable[[], Callable[[list], list]], out: str = "embedding") -> DataFrame:
    """A column embedded batch by batch; ``load`` runs once in each task and returns the model. A row that a batch fails on is tried alone, and null if it fails alone."""

    @F.pandas_udf("array<double>")
    def kernel(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()

        def alone(value):
            try:
                return model([value])[0]
            except Exception:  # one bad row is that row's failure, not its batch's
                return None

        for part in parts:
            values = part.tolist()
            try:
                yield pd.Series(model(values))
            except Exception:
                yield pd.Series([alone(v) for v in values])

    return df.withColumn(out, kernel(F.col(column)))


def generate(prompts: DataFrame, load: Callable[[], Callable[[str], bytes]], prefix: str = "synthetic", retries: int = 5) -> DataFrame:
    """(idx, prompt, name, content) of prompts (idx, prompt): the generator's answer to each enhanced prompt; null content where every attempt failed. Names keep the prompts' places."""
    named = prompts.select("idx", "prompt", enhanced_prompt("prompt").alias("asked"), numbered_name(F.lit(prefix), F.col("idx").cast("int"), ".png").alias("name"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = load()
        for part in parts:
            answers = []
            for asked in part["asked"]:
                answer = None
                for _ in range(retries):
                    try:
                        answer = make(asked)
                        break
                    except Exception:  # a failed attempt is tried again
                        continue
                answers.append(answer)
            yield part.drop(columns="asked").assign(content=answers)

    return named.mapInPandas(run, "idx int, prompt string, name string, content binary")


class SourceRegistry:
    """Names of sources and what makes them, in order of registration."""

    def __init__(self) -> None:
        self.makers: dict[str, Callable[..., object]] = {}

    def register(self, name: str) -> Callable:
        def add(maker: Callable[..., object]) -> Callable[..., object]:
            if name in self.makers:
                raise ValueError(f"the source {name} is there already")
            self.makers[name] = maker
            return maker

        return add

    def make(self, name: str, **options: object) -> object:
        return self.makers[name](**options)
