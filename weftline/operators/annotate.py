"""Annotation: a pluggable annotator over pending urls, results as documents, failures as data."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import coerce, text, urls
from weftline.operators import index

#: An annotator takes a url and its template and returns a payload.
Annotator = Callable[[str, str], dict]


#: The variable that holds a provider's key; others need none.
KEY_VARIABLES = {"openai": "OPENAI_API_KEY", "google": "GOOGLE_API_KEY"}


class Pace:
    """Calls of a task so far apart that all tasks together make `per_minute` a minute (0: as they come)."""

    def __init__(self, per_minute: int = 0, tasks: int = 1):
        self.apart, self.next = (60.0 * tasks / per_minute if per_minute > 0 else 0.0), 0.0

    def wait(self) -> float:
        """Sleep until the next call is due; how long that was."""
        now = time.monotonic()
        pause = max(0.0, self.next - now) if self.apart else 0.0
        self.next = max(now, self.next) + self.apart
        if pause:
            time.sleep(pause)
        return pause


@dataclass(frozen=True)
class Service:
    """Which model of which provider annotates, and how it is reached."""

    provider: str = "openai"
    model: str = "gpt-4o-mini"
    temperature: float = 0.0
    key: str | None = None
    base_url: str | None = None
    proxy: str | None = None
    proxy_user: str | None = None
    proxy_password: str | None = None
    headless: bool = True

    @classmethod
    def of(cls, variables: dict[str, str]) -> Service:
        """From variables as the environment has them; missing ones keep their defaults."""
        get = lambda name: variables.get(f"ANNOTATION_{name}") or None
        provider = (get("LLM_PROVIDER") or cls.provider).lower()
        return cls(
            provider, get("LLM_MODEL") or cls.model, float(get("LLM_TEMPERATURE") or 0.0), variables.get(KEY_VARIABLES.get(provider, "")), get("LLM_BASE_URL"),
            get("PROXY_URL"), get("PROXY_USERNAME"), get("PROXY_PASSWORD"), (get("HEADLESS") or "true").lower() in ("1", "true", "yes", "on"),
        )

    def require_key(self) -> None:
        if KEY_VARIABLES.get(self.provider) and not self.key:
            raise ValueError(f"{self.provider} needs {KEY_VARIABLES[self.provider]}")

    def config(self) -> dict:
        """The nested options that an annotator library takes."""
        llm = {"model": f"{self.provider}/{self.model}", "temperature": self.temperature, "api_key": self.key, "base_url": self.base_url}
        proxy = {"server": self.proxy, "username": self.proxy_user, "password": self.proxy_password}
        out: dict = {"llm": {k: v for k, v in llm.items() if v is not None}, "headless": self.headless, "verbose": False}
        if self.proxy:
            out["loader_kwargs"] = {"proxy": {k: v for k, v in proxy.items() if v}}
        return out


@dataclass(frozen=True)
class Options:
    """How a run is made: where records come from, which are taken, who annotates them."""

    source: str | None = None  # a file or folder of records
    store: str | None = None  # or a store
    limit: int = 0  # 0: all
    only_confirmed: bool = True
    force: bool = False
    mock: bool = False
    provider: str = "mock"
    model: str = "mock"
    key: str | None = None

    def __post_init__(self):
        if (self.source is None) == (self.store is None):
            raise ValueError("name either a source or a store")
        if not self.mock and not self.key:
            raise ValueError(f"{self.provider} needs a key")

    def select(self, records: DataFrame, done: DataFrame | None = None) -> DataFrame:
        """The records of this run, in their order of `seq` if there is a limit."""
        rows = index.pending(records, done, self.only_confirmed, self.force)
        return rows.orderBy("seq").limit(self.limit) if self.limit else rows


def mock_title(url: Column) -> Column:
    """The last path segment in title case, dashes and underscores as spaces."""
    slug = F.element_at(F.split(F.rtrim(urls.path(url), F.lit("/")), "/"), -1)
    slug = F.when(F.coalesce(slug, F.lit("")) == "", "untitled").otherwise(slug)
    return text.title_case(text.strip_spaces(F.translate(slug, "-_", "  ")))


def mock_payload(url: Column, family: str) -> Column:
    """What the offline annotator makes up, as native columns."""
    title = mock_title(url)
    own = {"title": title, "tags": F.array(F.lit("mock"))}
    if family == "editorial":
        own |= {"summary": F.concat(F.lit("[mock] Summary for editorial '"), title, F.lit("'.")), "category": F.lit("Guide")}
    else:
        own |= {"about": F.concat(F.lit("[mock] "), title, F.lit(" is a meme. This is mock annotation output.")), "entry_type": F.array(F.lit("Image Macro")), "status": F.lit("Confirmed")}
    return F.struct(*(own.get(n, coerce.default_of(k)).alias(n) for n, k in coerce.fields_of(family)))


def annotate(records: DataFrame, annotator: Annotator, attempts: int = 3, wait: float = 2.0, per_minute: int = 0, tasks: int = 1) -> DataFrame:
    """(url, template, raw, error) for records (url, page_template_type): the annotator's JSON or its error.

    A call is tried `attempts` times with growing waits; what fails for good becomes a row with an error,
    never a failed task. Repartition `records` to set how many calls run at once; with
    `per_minute` they are dealt to `tasks`, which together make no more calls a minute than that.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace = Pace(per_minute, tasks)
        for f in frames:
            out = []
            for url, kind in zip(f["url"], f["template"], strict=True):
                raw, error = None, None
                for i in range(attempts):
                    pace.wait()
                    try:
                        got = annotator(url, kind)
                        raw = got if isinstance(got, str) else json.dumps(got if isinstance(got, dict) else {}, ensure_ascii=False)
                        error = None
                        break
                    except Exception as e:  # an annotator may fail in any way
                        error = f"{type(e).__name__}: {e}"
                        if i + 1 < attempts:
                            time.sleep(wait**i)
                out.append((url, kind, raw, error))
            yield pd.DataFrame(out, columns=["url", "template", "raw", "error"])

    kind = F.coalesce("page_template_type", urls.template(F.col("url")))
    asked = records.select("url", kind.alias("template"))
    return (asked.repartition(tasks) if per_minute > 0 else asked).mapInPandas(run, "url string, template string, raw string, error string")


def checked(results: DataFrame, family: str) -> DataFrame:
    """Results with the typed `payload` of the family; a blank title is an error of its own."""
    typed = results.withColumn("payload", coerce.normalized(F.coalesce("raw", F.lit("{}")), family))
    blank = F.col("error").isNull() & (F.trim("payload.title") == "")
    return typed.withColumn("error", F.when(blank, "empty title").otherwise(F.col("error")))


def documents(records: DataFrame, results: DataFrame, at: str, model: str, provider: str) -> DataFrame:
    """One document for each result of a record: key, record, payload, and how it came about.

    Of several records of a url the greatest (Confirmed, lastmod) counts, so repeated urls make no pairs;
    a result without a url belongs to the records without one.
    """
    known = records.groupBy(F.col("url").alias("of")).agg(F.max(F.struct(F.col("Confirmed").alias("c"), F.col("lastmod").alias("lm"))).alias("r"))
    kind = F.col("template")
    return results.join(known.select("of", "r.c", "r.lm"), F.col("url").eqNullSafe(F.col("of"))).select(
        urls.document_id(F.col("url")).alias("_id"), "url", F.coalesce("c", F.lit(False)).alias("confirmed"), F.col("lm").alias("lastmod"),
        kind.alias("page_template_type"), F.lit(at).alias("last_scraped"), F.col("payload").alias("meme"),
        F.struct(F.lit(provider).alias("provider"), F.lit(model).alias("model"), urls.family(kind).alias("schema_family"), F.col("error").isNull().alias("ok"), F.col("error").alias("error"), F.lit(at).alias("annotated_at")).alias("_annotation"),
    )


def outcome(docs: DataFrame) -> DataFrame:
    """(ok, failed) counts of a run."""
    return docs.agg(F.count_if(F.col("_annotation.ok")).alias("ok"), F.count_if(~F.col("_annotation.ok")).alias("failed"))
