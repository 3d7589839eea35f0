"""Models behind a small interface, called in Arrow batches; stubs for tests and for machines without one."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiva.functions.quality import is_valid, output_flags
from archiva.functions.text import blank, strip
from archiva.operators.entities import flatten_payload, json_in_prose, normalize_payload


class Backend(Protocol):
    """What turns a batch of inputs into answers; made once per task by a factory."""

    def available(self) -> bool: ...

    def run(self, inputs: Sequence) -> list[str | None]: ...


class Stub:
    """Answers from a function, for tests."""

    def __init__(self, answer: Callable[[object], str | None], up: bool = True) -> None:
        self.answer, self.up = answer, up

    def available(self) -> bool:
        return self.up

    def run(self, inputs: Sequence) -> list[str | None]:
        return [self.answer(x) for x in inputs]


class Http:
    """A model behind a web address: one JSON request per input, the answer taken out of the reply."""

    def __init__(
        self, url: str, body: Callable[[object], dict], read: Callable[[dict], str | None], check: str | None = None, seconds: float = 300.0, headers: Mapping[str, str] | None = None, key_variable: str | None = None
    ) -> None:
        """``headers`` go with each request; ``key_variable`` names the environment variable that holds a bearer key, which
        is read where the request is made, so that no plan or log has it."""
        self.url, self.body, self.read, self.check, self.seconds, self.headers, self.key_variable = url, body, read, check, seconds, dict(headers or {}), key_variable

    def available(self) -> bool:
        """Whether the check address answers within five seconds."""
        from urllib.request import urlopen

        try:
            with urlopen(self.check or self.url, timeout=5) as r:
                return r.status < 400
        except OSError:
            return False

    def run(self, inputs: Sequence) -> list[str | None]:
        import json
        import os
        from urllib.request import Request, urlopen

        out = []
        for x in inputs:
            key = {"Authorization": f"Bearer {os.environ[self.key_variable]}"} if self.key_variable else {}
            ask = Request(self.url, json.dumps(self.body(x)).encode(), {"Content-Type": "application/json", **self.headers, **key})
            with urlopen(ask, timeout=self.seconds) as r:
                out.append(self.read(json.load(r)))
        return out


def answer(model: Backend, xs: list, tries: int = 2) -> list[str | None]:
    """The model's answers to a batch; null inputs are not sent.

    If a batch fails, its inputs are sent one by one, each up to ``tries`` times; only those that fail then are null.
    """
    at = [i for i, x in enumerate(xs) if x is not None]
    answers: list[str | None] = [None] * len(xs)
    try:
        for i, a in zip(at, model.run([xs[i] for i in at]), strict=True):
            answers[i] = a
    except Exception:  # noqa: BLE001 - a model may fail in any way; what fails by itself stays unanswered
        for i in at:
            for _ in range(tries):
                try:
                    (answers[i],) = model.run([xs[i]])
                    break
                except Exception:  # noqa: BLE001
                    continue
    return answers


def infer(df: DataFrame, inputs: str, factory: Callable[[], Backend], out: str, tries: int = 2) -> DataFrame:
    """``df`` with the backend's answer to ``inputs``, see answer()."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for b in batches:
            answers = answer(model, b.column(b.schema.names.index(inputs)).to_pylist(), tries)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(answers, pa.string())], names=[*b.schema.names, out])

    return df.mapInArrow(run, f"{schema}, `{out}` string")


def ask(c: Column, factory: Callable[[], Backend], tries: int = 2) -> Column:
    """The backend's answer to a column, see answer(); in Arrow batches of this column alone, so other columns stay where they are."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        for b in batches:
            yield pa.array(answer(model, b.to_pylist(), tries), pa.string())

    # a call is dear: no plan may repeat or move it
    return F.arrow_udf(run, "string").asNondeterministic()(c)


def choose_attempt(attempts: Column, keep: str = "last") -> Column:
    """Of a page's outputs in the order of the attempts: the first valid one, else the last (or first) that is not blank."""
    valid = F.filter(attempts, lambda x: is_valid(output_flags(x)))
    full = F.filter(attempts, lambda x: ~blank(x))
    rest = F.try_element_at(full, F.lit(-1 if keep == "last" else 1))
    return F.coalesce(F.try_element_at(valid, F.lit(1)), rest, F.lit(""))


def recognise(crops: DataFrame, image: str, factories: Sequence[Callable[[], Backend]], keep: str = "last") -> DataFrame:
    """``crops`` with ocr_text and ocr_flags: each factory is one prompt; the choice is choose_attempt's."""
    d = crops
    for k, f in enumerate(factories):
        d = infer(d, image, f, f"_try{k}")
    text = choose_attempt(F.array(*(F.coalesce(f"_try{k}", F.lit("")) for k in range(len(factories)))), keep)
    d = d.withColumn("ocr_text", text).drop(*(f"_try{k}" for k in range(len(factories))))
    return d.withColumn("ocr_flags", F.array_join(output_flags(F.col("ocr_text")), "; "))


def extract_entities(df: DataFrame, pos: str, text: str, factory: Callable[[], Backend], most: int | None = None) -> DataFrame:
    """``df`` with tipo, personas, naos, lugares, atributos from a model's answers to the texts that are not blank.

    Without a model the columns are blank. ``most`` asks for the first records only, before any call. An answer without
    JSON is otros; a failed call has tipo ''.
    """
    names = ["tipo", "personas", "naos", "lugares", "atributos"]
    base = df.drop(*names)
    if not factory().available():
        return base.withColumns({c: F.lit("") for c in names})
    asked = ~blank(F.col(text))
    if most is not None:
        first = base.where(asked).select(pos).orderBy(pos).limit(most)
        base, asked = base.join(first.withColumn("_ask", F.lit(True)), pos, "left"), F.col("_ask")
    answers = base.withColumn("_answer", ask(F.when(asked, F.col(text)), factory))
    payload = normalize_payload(json_in_prose(F.col("_answer")))
    flat = flatten_payload(answers.withColumn("_p", payload), "_p").withColumn("tipo", F.when(F.col("_answer").isNull(), "").otherwise(F.col("tipo")))
    return flat.select(*(c for c in base.columns if c != "_ask"), *(F.coalesce(strip(F.col(c)), F.lit("")).alias(c) for c in names))
