"""Answers of web services to a table of requests: a bounded rate, tries with growing pauses, errors as rows.

Requests are spread over a fixed number of lanes, one task each; a lane sends one request after the other and never more than
its share of the rate, so the service sees the same load whatever the number of requests and executors. A request that keeps
failing is a row with an error, not the end of the job. A task that runs again sends its requests again; services are only read.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._columns import Text, col
from ..providers import Provider
from .pages import accessible

#: Status, content type and body of the answer to an address; raises what a request can raise.
Get = Callable[[str, str], tuple[int, str, str]]
ANSWER = "status int, content_type string, body string, error string, tries int"


def http(address: str, method: str = "GET", timeout: float = 15.0, headers: dict[str, str] | None = None) -> tuple[int, str, str]:
    request = urllib.request.Request(address, method=method, headers=headers or {})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as got:
            return got.status, got.headers.get("Content-Type", ""), got.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, e.headers.get("Content-Type", "") if e.headers else "", ""


@dataclass(frozen=True)
class Service:
    """How to ask a service: `per_second` over all lanes (None: no bound), `lanes` requests at a time, pauses of `pause` seconds
    that grow by `growth`. Statuses in `again` are tried again, as are errors of the connection."""

    get: Get = http
    per_second: float | None = 1.0
    lanes: int = 1
    tries: int = 3
    pause: float = 5.0
    growth: float = 2.0
    again: tuple[int, ...] = field(default=(408, 425, 429, 500, 502, 503, 504))

    def ask(self, address: str, method: str, wait: Callable[[], None]) -> tuple[int | None, str | None, str | None, str | None, int]:
        said = None
        for n in range(1, self.tries + 1):
            wait()
            try:
                status, kind, body = self.get(address, method)
                if status not in self.again:
                    return status, kind, body, None if status < 400 else f"status {status}", n
                said = f"status {status}"
            except Exception as e:  # noqa: BLE001 - whatever a request raises becomes a row
                said = f"{type(e).__name__}: {e}"
            if n < self.tries:
                time.sleep(self.pause * self.growth ** (n - 1))
        return None, None, None, said, self.tries


def fetched(requests: DataFrame, service: Service, address: str = "address", method: str = "GET") -> DataFrame:
    """requests with status, content_type, body, error and tries.

    A row without an address has the error "no address" and is not sent. Equal addresses are asked for once each row: make rows
    distinct before. Columns of the input named like those of the answer are replaced.
    """
    own = [c for c in requests.columns if c not in ("status", "content_type", "body", "error", "tries")]
    rows = requests.select(*own)
    least = 0.0 if service.per_second is None else service.lanes / service.per_second

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None

        def wait() -> None:
            nonlocal last
            now = time.monotonic()
            if last is not None and now - last < least:
                time.sleep(least - (now - last))
            last = time.monotonic()

        for batch in batches:
            got = [(None, None, None, "no address", 0) if not isinstance(a, str) or not a else service.ask(a, method, wait) for a in batch[address]]
            said = pd.DataFrame(got, columns=["status", "content_type", "body", "error", "tries"], index=batch.index)
            said["status"] = said["status"].astype("Int32")
            yield pd.concat([batch, said], axis=1)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [ANSWER])
    return rows.repartition(service.lanes).mapInPandas(run, schema)


def reachable(rows: DataFrame, service: Service, url: str = "url", out: str = "accessible") -> DataFrame:
    """rows with `accessible`: whether the paper behind an address can be read. Each address is asked for once, by HEAD."""
    asked = rows.select(F.col(url).alias("_u")).where("_u IS NOT NULL").distinct()
    said = fetched(asked, service, "_u", "HEAD").select("_u", accessible("status", "content_type", "_u").alias(out))
    return rows.drop(out).join(said, F.col(url) == F.col("_u"), "left").drop("_u")


# Addresses of the search services, the fields asked for, and how many results a search returns.
OPENALEX = "https://api.openalex.org/works"
SEMANTIC_SCHOLAR = "https://api.semanticscholar.org/graph/v1/paper/search"
FIELDS = "title,abstract,year,citationCount,externalIds,url"
RESULTS = 5


def search_address(source: Text, query: Text, mail: str | None = None, most: int = RESULTS) -> Column:
    """Where a service answers a query; null for a service that is not known."""
    q = F.url_encode(col(query))
    contact = F.concat(F.lit("&mailto="), F.url_encode(F.lit(mail))) if mail else F.lit("")
    works = F.concat(F.lit(f"{OPENALEX}?search="), q, F.lit(f"&per_page={most}"), contact)
    papers = F.concat(F.lit(f"{SEMANTIC_SCHOLAR}?query="), q, F.lit(f"&limit={most}&fields={FIELDS}"))
    return F.when(col(source) == "openalex", works).when(col(source) == "semantic_scholar", papers)


def search(services: dict[str, Service], mail: str | None = None) -> Provider:
    """A provider that asks each of the services, in this order, each query once.

    From (key, query, query_no) it makes (key, query, query_no, source, source_no, place, json, error): a row for each result,
    and one without json for a query that failed or found nothing, its error then null.
    """

    def run(queries: DataFrame) -> DataFrame:
        asked = queries.select("query").where("query IS NOT NULL").distinct()
        found = None
        for no, (name, service) in enumerate(services.items()):
            sent = asked.select("query", search_address(F.lit(name), "query", mail).alias("address"))
            got = fetched(sent, service)
            read = F.from_json("body", "results array<string>, data array<string>")
            results = F.coalesce(read["results"], read["data"])
            broken = F.when(F.col("error").isNull() & read["results"].isNull() & read["data"].isNull(), "no results in the answer")
            rows = got.select("query", F.lit(name).alias("source"), F.lit(no).alias("source_no"), F.posexplode_outer(F.slice(results, 1, RESULTS)).alias("place", "json"), F.coalesce("error", broken).alias("error"))
            found = rows if found is None else found.unionByName(rows)
        return queries.select("key", "query", "query_no").join(found, "query").select("key", "query", "query_no", "source", "source_no", "place", "json", "error")

    return run
