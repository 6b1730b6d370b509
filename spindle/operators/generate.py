"""Completions from an external model: rounds, fan-out, retries and resumption around a pluggable client."""

from __future__ import annotations

import hashlib
import json
import time
import urllib.request
import warnings
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import py_strip, seeded
from ..sources.jsonl import remaining


#: Conversations that a task has open at once.
IN_FLIGHT = 64


class Client(Protocol):
    """Answers a conversation; called by several threads at once."""

    def complete(self, messages: list[dict[str, str]], temperature: float, top_p: float, max_tokens: int) -> str: ...


@dataclass(frozen=True)
class StubClient:
    """Answers with a digest of the conversation: the same for the same turns."""

    name: str = "stub"

    def complete(self, messages, temperature=0.8, top_p=0.95, max_tokens=2048) -> str:
        return hashlib.md5("\n".join(f"{m['role']}:{m['content']}" for m in messages).encode()).hexdigest()


@dataclass(frozen=True)
class HttpClient:
    """A client of any service that speaks the chat-completions protocol: ``POST {url}/chat/completions``, bearer key."""

    url: str
    model: str
    key: str = ""
    timeout_s: float = 600.0

    def complete(self, messages, temperature=0.8, top_p=0.95, max_tokens=2048) -> str:
        body = {"model": self.model, "messages": messages, "temperature": temperature, "top_p": top_p, "max_tokens": max_tokens, "n": 1, "stream": False}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        request = urllib.request.Request(f"{self.url.rstrip('/')}/chat/completions", json.dumps(body).encode(), headers)
        with urllib.request.urlopen(request, timeout=self.timeout_s) as reply:
            return json.load(reply)["choices"][0]["message"]["content"] or ""


CLIENTS: dict[str, Callable[[], Client]] = {"stub": StubClient}


def register_client(name: str, make: Callable[[], Client]) -> None:
    """Adds a provider under a model name; ``make`` runs in each worker."""
    CLIENTS[name] = make


def client_for(name: str | Callable[[], Client]) -> Callable[[], Client]:
    if callable(name):
        return name
    if name not in CLIENTS:
        raise ValueError(f"unknown model {name!r}")
    return CLIENTS[name]


def converse(client: Client, system: str, user: list[str], temperature: float, top_p: float, max_tokens: int, retries: int, wait_s: float) -> tuple[list[str], str | None]:
    """The answers of all rounds, each of which sees the turns before, and an error where a round never got one."""
    messages, answers = [{"role": "system", "content": system}], []
    for text in user:
        messages.append({"role": "user", "content": text})
        answer, error = "", None
        for attempt in range(retries):
            try:
                answer, error = client.complete(messages, temperature, top_p, max_tokens), None
            except Exception as e:  # noqa: BLE001  any failure of the service is tried again, then reported
                error = f"{type(e).__name__}: {e}"
            if answer:
                break
            if attempt + 1 < retries:
                time.sleep(wait_s)
        if not answer:
            return answers, error or "empty answer"
        answers.append(answer)
        messages.append({"role": "assistant", "content": answer})
    return answers, None


def generate(prompts: DataFrame, model: str | Callable[[], Client] = "stub", num_completion: int = 1, max_samples: int | None = None, key: str = "request_id", done: DataFrame | None = None, temperature: float = 0.8, top_p: float = 0.95, max_tokens: int = 2048, retries: int = 5, wait_s: float = 10.0, seed: int = 42, in_flight: int = IN_FLIGHT) -> DataFrame:
    """``num_completion`` answers to each prompt: its columns, ``sample_index`` from 1, ``response`` (one answer for each
    round) and ``error``.

    ``user`` is a string or an array of strings, one for each round; prompts with a blank round are skipped. Requests in
    ``done`` are left out, so a broken run goes on where it stopped and answers each request once. Columns that have the
    names of the result's are replaced.

    A task has up to ``in_flight`` conversations open at once, over one client, whose ``complete`` runs in as many
    threads; each keeps its rounds in order, and one that waits for a busy service holds up no other. The next rows are
    taken up while the last of a batch are still open, so two batches are held at a time.
    """
    make = client_for(model)
    prompts = prompts.drop("sample_index", "response", "error")
    d = prompts if prompts.schema["user"].dataType.typeName() == "array" else prompts.withColumn("user", F.array("user"))
    d = d.filter(~F.exists("user", lambda t: py_strip(t) == ""))
    if max_samples is not None:
        d = d.orderBy(seeded(seed, key), key).limit(max_samples)
    d = d.withColumn("sample_index", F.explode(F.sequence(F.lit(1), F.lit(num_completion))))
    if done is not None:
        d = remaining(d, done, [key, "sample_index"])
    schema = d.select("*", F.lit(None).cast("array<string>").alias("response"), F.lit(None).cast("string").alias("error")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()

        def answered(batch: pd.DataFrame, asked: list[Future]) -> pd.DataFrame:
            got = [f.result() for f in asked]
            return batch.assign(response=[g[0] for g in got], error=[g[1] for g in got])

        with ThreadPoolExecutor(in_flight) as pool:
            before = None
            for batch in batches:
                asked = [pool.submit(converse, client, s or "", list(u), temperature, top_p, max_tokens, retries, wait_s) for s, u in zip(batch["system"], batch["user"])]
                if before:
                    yield answered(*before)
                before = batch, asked
            if before:
                yield answered(*before)

    return d.mapInPandas(run, schema)


def generate_saved(prompts: DataFrame, path: str, portions: int = 10, key: str = "request_id", num_completion: int = 1, **options) -> DataFrame:
    """Like :func:`generate`, saved while it goes on: portions of the requests, by hash, are appended to JSON lines one after
    another. Started again with the same ``path``, it asks only for what isn't there yet or ended in an error."""
    spark = prompts.sparkSession
    schema = prompts.drop("sample_index", "response", "error").schema
    schema = T.StructType([f if f.name != "user" else T.StructField("user", T.ArrayType(T.StringType())) for f in schema.fields])
    schema = schema.add("sample_index", T.IntegerType()).add("response", T.ArrayType(T.StringType())).add("error", T.StringType())

    def saved() -> DataFrame:
        try:
            return spark.read.schema(schema).json(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    for k in range(portions):
        part = prompts.filter(F.pmod(F.xxhash64(key), F.lit(portions)) == k)
        generate(part, key=key, num_completion=num_completion, done=saved().filter("error is null"), **options).write.mode("append").json(path)
    return saved().filter("error is null").dropDuplicates([key, "sample_index"])


def flatten_rounds(df: DataFrame, rounds: int) -> DataFrame:
    """Adds ``response_1`` and so on, null where a round has no answer."""
    return df.withColumns({f"response_{k}": F.get("response", F.lit(k - 1)) for k in range(1, rounds + 1)})


def output_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """The listed columns in their order; those that don't exist are left out, with a warning."""
    if missing := [f for f in fields if f not in df.columns]:
        warnings.warn(f"no such output field: {', '.join(missing)}", stacklevel=2)
    return df.select(*[f for f in fields if f in df.columns])
