"""Fact generation: prompts, a pluggable generator, filtering and totals.

A generator answers a prompt with (JSON text, input tokens, output tokens).
It is called inside the tasks, with retries there, so that Spark never repeats a
paid call because of one bad answer; results are made durable before they are
read a second time. One failed chunk fails its page.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fact_prompt, leaks_source, strip
from ..session import materialise

#: Currency per million input and output tokens (fixed values).
PRICE_IN, PRICE_OUT = 0.25, 1.50


class Generator(Protocol):
    def __call__(self, prompt: str) -> tuple[str, int, int]: ...


def echo_generator(prompt: str) -> tuple[str, int, int]:
    """Deterministic stand-in without a network: the text's sentences as facts."""
    body = prompt.split("\n\n", 1)[-1]
    facts = [s.strip() for s in body.replace("\n", " ").split(". ") if s.strip() and not s.strip().startswith("#")]
    return json.dumps({"facts": facts}), len(prompt) // 4, sum(map(len, facts)) // 4


class ServiceGenerator:
    """A model behind an HTTP interface: ``body`` makes the request, ``read`` gives (answer, tokens in, tokens out) of its JSON."""

    def __init__(self, url: str, body: Callable[[str], dict], read: Callable[[dict], tuple[str, int, int]], headers: dict[str, str] | None = None,
                 post: Callable[[str, bytes, dict[str, str]], bytes] | None = None):
        self.url, self.body, self.read, self.headers, self.post = url, body, read, headers or {}, post or _post

    def __call__(self, prompt: str) -> tuple[str, int, int]:
        raw = self.post(self.url, json.dumps(self.body(prompt)).encode(), {"Content-Type": "application/json", **self.headers})
        return self.read(json.loads(raw))


def _post(url: str, body: bytes, headers: dict[str, str]) -> bytes:
    from urllib.request import Request, urlopen

    with urlopen(Request(url, data=body, headers=headers), timeout=300) as r:
        return r.read()


def choose_generator(local_model: str | None = None, local_url: str = "http://127.0.0.1:11434/api/generate", hosted_url: str | None = None, key: str | None = None, post=None) -> Generator:
    """A local model if one is named, else the hosted one, which needs a key; a local model costs nothing per token."""
    if local_model:
        return ServiceGenerator(local_url, lambda p: {"model": local_model, "prompt": p, "format": "json", "stream": False},
                                lambda d: (d["response"], int(d.get("prompt_eval_count", 0)), int(d.get("eval_count", 0))), post=post)
    if not hosted_url or not key:
        raise SystemExit(2)
    return ServiceGenerator(hosted_url, lambda p: {"contents": [{"parts": [{"text": p}]}], "generationConfig": {"responseMimeType": "application/json"}},
                            lambda d: (d["candidates"][0]["content"]["parts"][0]["text"], int(d.get("usageMetadata", {}).get("promptTokenCount", 0)), int(d.get("usageMetadata", {}).get("candidatesTokenCount", 0))),
                            {"x-goog-api-key": key}, post)


def parse_answer(answer: str) -> list[str]:
    """The facts of an answer; ValueError if it is not {"facts": [strings]}."""
    value = json.loads(answer)
    facts = value.get("facts") if isinstance(value, dict) else None
    if not isinstance(facts, list) or not all(isinstance(f, str) for f in facts):
        raise ValueError("no list of facts")
    return facts


def ask(generator: Generator, prompt: str, retries: int = 5, first_wait: float = 2.0, longest: float = 60.0,
        sleep: Callable[[float], None] = time.sleep) -> tuple[list[str], int, int, str | None]:
    """(facts, tokens in, tokens out, error) with doubled waits between tries."""
    wait, error = first_wait, ""
    for n in range(retries):
        try:
            answer, a, b = generator(prompt)
            return parse_answer(answer), a, b, None
        except Exception as e:  # noqa: BLE001 - any failure of the service is retried
            error = f"{type(e).__name__}: {e}"
            if n + 1 < retries:
                sleep(wait)
                wait = min(longest, 2 * wait)
    return [], 0, 0, error


def generate(chunks: DataFrame, generator: Generator = echo_generator, n_facts: int = 50, retries: int = 5, first_wait: float = 2.0) -> DataFrame:
    """(page, chunk_index, facts, tokens_in, tokens_out, error) of (page, title, chunk_index, chunk_total, text) rows, durable."""
    prompt = fact_prompt(F.col("text"), F.col("title"), F.col("chunk_index"), F.col("chunk_total"), F.lit(n_facts))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [ask(generator, p, retries, first_wait) for p in b["prompt"]]
            yield pd.DataFrame({
                "page": b["page"], "chunk_index": b["chunk_index"], "facts": [g[0] for g in got],
                "tokens_in": [g[1] for g in got], "tokens_out": [g[2] for g in got], "error": [g[3] for g in got]})

    schema = "page string, chunk_index int, facts array<string>, tokens_in long, tokens_out long, error string"
    return materialise(chunks.select("page", "chunk_index", prompt.alias("prompt")).mapInPandas(run, schema), "facts")


def complete_pages(results: DataFrame) -> DataFrame:
    """(page, failed, tokens_in, tokens_out): a page fails if any of its chunks did, and then counts no tokens."""
    x = results.groupBy("page").agg(F.max(F.col("error").isNotNull()).alias("failed"), F.sum("tokens_in").alias("i"), F.sum("tokens_out").alias("o"))
    return x.select("page", "failed", F.when(F.col("failed"), 0).otherwise(F.col("i")).alias("tokens_in"), F.when(F.col("failed"), 0).otherwise(F.col("o")).alias("tokens_out"))


def kept_facts(results: DataFrame) -> DataFrame:
    """(fact, source_page, dropped): facts of complete pages; empty and source-pointing ones are marked dropped."""
    pages = complete_pages(results).where("not failed").select("page")
    x = results.join(pages, "page", "left_semi").select(F.col("page").alias("source_page"), F.explode("facts").alias("fact"))
    fact = strip(F.col("fact"))
    return x.select(fact.alias("fact"), "source_page", ((fact == "") | leaks_source(fact)).alias("dropped"))


def cost(tokens_in: Column, tokens_out: Column, price_in: float = PRICE_IN, price_out: float = PRICE_OUT) -> Column:
    return tokens_in * F.lit(price_in) / 1e6 + tokens_out * F.lit(price_out) / 1e6


def totals(results: DataFrame, price_in: float = PRICE_IN, price_out: float = PRICE_OUT) -> DataFrame:
    """One row: pages, failures, facts, dropped, tokens and cost of a run."""
    p = complete_pages(results).agg(F.lit(0).alias("one"), F.count("*").alias("pages"), F.coalesce(F.sum(F.col("failed").cast("int")), F.lit(0)).alias("failures"),
                                    F.coalesce(F.sum("tokens_in"), F.lit(0)).alias("tokens_in"), F.coalesce(F.sum("tokens_out"), F.lit(0)).alias("tokens_out"))
    f = kept_facts(results).agg(F.lit(0).alias("one"), F.coalesce(F.sum((~F.col("dropped")).cast("int")), F.lit(0)).alias("facts"), F.coalesce(F.sum(F.col("dropped").cast("int")), F.lit(0)).alias("dropped"))
    return p.join(f, "one").drop("one").withColumn("cost", cost(F.col("tokens_in"), F.col("tokens_out"), price_in, price_out))
