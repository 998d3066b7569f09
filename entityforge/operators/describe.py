"""Description enrichment by a language-model client: the shipped one, or any that is injected."""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityforge.functions.text import strip
from entityforge.session import shared_dir
from entityforge.sources.http import Poster, post_url

#: Descriptions from this length on are useful as they are. Facts sent are cut to this many characters.
USEFUL_LENGTH, FACTS_LENGTH = 80, 800
ATTEMPTS = 3
#: The environment's key and model setting, the model without one, and the public endpoint.
KEY_SETTING, MODEL_SETTING, DEFAULT_MODEL = "GEMINI_API_KEY", "DESCRIPTION_MODEL", "gemini-3.6-flash"
ENDPOINT = "https://generativelanguage.googleapis.com/v1beta/models/%s:generateContent"
TIMEOUT_S = 60

PROMPT = (
    "Write one catalog description, one or two sentences, under 40 words, from these facts only.\n"
    "Add nothing, use no marketing language, do not start with the name.\n"
    "Type: %s\nName: %s\nFacts: %s\nAnswer with the description alone."
)


def needs_description(c: Column) -> Column:
    """Some text, but less than a useful description; nothing is ever made up from nothing."""
    n = F.length(strip(F.coalesce(c, F.lit(""))))
    return (n > 0) & (n < USEFUL_LENGTH)


def prompt_of() -> Column:
    """The prompt of an entity."""
    facts = F.when(F.size("metadata") > 0, F.concat(F.col("description"), F.lit(" | metadata: "), F.to_json("metadata"))).otherwise(F.col("description"))
    return F.format_string(PROMPT, F.col("entity_type"), F.col("name"), F.substring(facts, 1, FACTS_LENGTH))


def retry_delay(value: object) -> float | None:
    """Seconds in a number, in {seconds, nanos} or in text like "51s"; never negative."""
    if isinstance(value, dict) and value.get("seconds") is not None:
        value = float(value["seconds"]) + float(value.get("nanos") or 0) / 1e9
    if isinstance(value, str):
        found = re.search(r"(\d+(?:\.\d+)?)\s*s", value)
        value = float(found[1]) if found else None
    return max(float(value), 0.0) if isinstance(value, int | float) else None


def delay_in(details: object) -> float | None:
    """The first retry delay anywhere in nested error details, the last branch looked at first."""
    todo, seen = [details], set()
    while todo:
        here = todo.pop()
        if id(here) in seen or not isinstance(here, dict | list):
            continue
        seen.add(id(here))
        if isinstance(here, dict):
            for key in ("retryDelay", "retry_delay"):
                if (delay := retry_delay(here.get(key))) is not None:
                    return delay
            todo += here.values()
        else:
            todo += here
    return None


class ServiceError(Exception):
    """The service's refusal, with what it said."""

    def __init__(self, code: int, status: str, details: object, message: str = ""):
        super().__init__(f"{code} {status}. {message}")
        self.code, self.status, self.details = code, status, details


def is_quota_error(error: Exception, strict: bool = False) -> bool:
    """Whether the service refused for its quota: code 429, or status or message RESOURCE_EXHAUSTED.

    `strict`: the word must also be in the details where they are an object, and in the message where
    they are not; a bare code 429 is then no quota error.
    """
    word, status, details = "RESOURCE_EXHAUSTED", str(getattr(error, "status", "") or "").upper(), getattr(error, "details", None)
    refused = getattr(error, "code", None) == 429 or status == word or word in str(error).upper()
    return refused and (not strict or word in (str(details) if isinstance(details, dict) else str(error)).upper())


def client_from_env(post: Poster = post_url) -> Callable[[], Callable[[str], str]] | None:
    """A client of the service that the environment's key is for; None without a key.

    Key and model are read here, on the driver; each task makes its own connection.
    """
    key, model = os.environ.get(KEY_SETTING), os.environ.get(MODEL_SETTING) or DEFAULT_MODEL
    if not key:
        return None

    def connect() -> Callable[[str], str]:
        def ask(prompt: str) -> str:
            body = json.dumps({"contents": [{"parts": [{"text": prompt}]}]}).encode()
            answer = post(ENDPOINT % model, {"Content-Type": "application/json", "x-goog-api-key": key}, body, TIMEOUT_S)
            try:
                said = json.loads(answer.body or b"{}")
            except ValueError:
                said = {}
            if answer.status != 200:
                error = said.get("error", {}) if isinstance(said, dict) else {}
                raise ServiceError(answer.status, error.get("status", ""), said, error.get("message", ""))
            return said["candidates"][0]["content"]["parts"][0].get("text", "")

        return ask

    return connect


def described(prompt: str, facts: str, ask: Callable[[str], str], sleep: Callable[[float], None] = time.sleep, strict: bool = False) -> tuple[str | None, str]:
    """(answer, reason): the client's answer and '', or none and why: blank facts, an empty answer or the last failure.

    A quota error that names a delay is waited out, twice at most; `strict` as in `is_quota_error`.
    """
    if not facts.strip():
        return None, "no facts"
    for attempt in range(ATTEMPTS):
        try:
            said = (ask(prompt) or "").strip()
            return (said, "") if said else (None, "empty answer")
        except Exception as error:  # noqa: BLE001 - enrichment never fails a run
            delay = delay_in(getattr(error, "details", None)) if is_quota_error(error, strict) else None
            if delay is None or attempt == ATTEMPTS - 1:
                return None, f"{type(error).__name__}: {error}"
            sleep(delay)
    return None, "no attempts"


def describe_one(prompt: str, facts: str, ask: Callable[[str], str], sleep: Callable[[float], None] = time.sleep, strict: bool = False) -> str:
    """The client's answer, or the facts as they were: for blank facts, an empty answer or any failure."""
    return described(prompt, facts, ask, sleep, strict)[0] or facts


@dataclass
class TokenBucket:
    """Lets `rate` calls a second pass on average and `burst` at once; None as rate lets all pass."""

    rate: float | None
    burst: int = 1
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    tokens: float = field(init=False)
    last: float = field(init=False)

    def __post_init__(self):
        self.tokens, self.last = float(self.burst), self.clock()

    def take(self) -> None:
        """Waits until a call may be made."""
        if self.rate is None:
            return
        now = self.clock()
        self.tokens = min(self.tokens + (now - self.last) * self.rate, self.burst)
        self.last = now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.rate)
            self.last = self.clock()
            self.tokens = 1.0
        self.tokens -= 1


def _asking(client: Callable[[], Callable[[str], str]], rate: float | None):
    """Rows (id, print, description, prompt) to rows of the ledger; `rate` calls a second in each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask, bucket = None, TokenBucket(rate)

        def one(prompt: str) -> str:
            bucket.take()
            return ask(prompt)

        for batch in batches:
            ask = ask or client()
            found = [described(p, d, one) for p, d in zip(batch["prompt"], batch["description"])]
            yield pd.DataFrame({"id": batch["id"], "print": batch["print"], "answer": [a for a, _ in found], "reason": [r for _, r in found]})

    return run


LEDGER = "id string, print string, answer string, reason string"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All answers and failures so far; before the first, no rows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", True).parquet(ledger)


def describe_all(
    entities: DataFrame, client: Callable[[], Callable[[str], str]] | None, workers: int = 1, ledger: str | None = None, batch_rows: int = 50, per_minute: float | None = None
) -> DataFrame:
    """Rewrites the descriptions that need it; without a client, the identity.

    Only those rows reach Python, dealt to `workers` tasks, which together make `per_minute` calls a minute at most.
    What was answered goes to a ledger, by the entity's id and a hash of the prompt: a run asks for nothing that
    the ledger at `ledger` answers, and what failed is asked again and keeps its reason. The open questions are
    files of `batch_rows` rows, which a stream takes one for each worker at a time, so a run or a task that is lost
    repeats the calls of one such batch. Without `ledger`, a run has one of its own.
    """
    if client is None:
        return entities
    spark = entities.sparkSession
    scratch = f"{shared_dir(spark)}/describe-{uuid.uuid4().hex}"
    ledger = ledger or f"{scratch}/ledger"
    keyed = entities.withColumn("_prompt", F.when(needs_description(F.col("description")), prompt_of())).withColumn("_print", F.sha2("_prompt", 256))
    answered = read_ledger(spark, ledger).filter("answer is not null").select("id", "print").distinct()
    asked = keyed.filter("_prompt is not null").select("id", F.col("_print").alias("print"), "description", F.col("_prompt").alias("prompt"))
    asked = asked.dropDuplicates(["id", "print"]).join(answered, ["id", "print"], "left_anti")
    # without the shuffle, all that leads up to the rows would run in as few tasks
    asked.repartition(workers).write.option("maxRecordsPerFile", batch_rows).parquet(f"{scratch}/asked")
    rate = None if per_minute is None else per_minute / 60 / workers
    run = _asking(client, rate)

    def write(batch: DataFrame, number: int) -> None:
        batch.select("id", "print", "description", "prompt").repartition(workers).mapInPandas(run, LEDGER).write.mode("overwrite").parquet(f"{ledger}/{scratch.rpartition('-')[2]}-{number}")

    stream = spark.readStream.schema("id string, print string, description string, prompt string").option("maxFilesPerTrigger", workers).parquet(f"{scratch}/asked")
    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{scratch}/mark").trigger(availableNow=True).start().awaitTermination()
    # one answer of a question, also where two runs asked it at once
    told = read_ledger(spark, ledger).filter("answer is not null").groupBy(F.col("id").alias("_id"), F.col("print").alias("_of")).agg(F.min("answer").alias("_text"))
    met = keyed.join(told, (F.col("id") == F.col("_id")) & (F.col("_print") == F.col("_of")), "left")
    return met.withColumn("description", F.coalesce("_text", "description")).select(entities.columns)
