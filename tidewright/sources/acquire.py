"""Acquisition: probing hosts, checking sites, searching and fetching pages through an injected client.

A client is any picklable callable; tests and replays pass one backed by a table. Work is done once per distinct key, in
``mapInPandas`` partitions, and written back by joins; known keys are left out by anti joins, so a rerun after a lost
executor repeats only what was not stored.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions import contact as c
from tidewright.functions import urls as u
from tidewright.operators.pages import is_soft_error, parsed_pages

#: (url) -> (final url, status or None, error or None)
Probe = Callable[[str], tuple[str, int | None, str | None]]


def probe_hosts(hosts: DataFrame, column: str, probe: Probe) -> DataFrame:
    """(column, website, code): the first variant of each distinct host that answers 2xx; hosts without one are left out."""
    todo = hosts.select(column).where(F.col(column).isNotNull()).distinct().withColumn("variants", u.probe_variants(column)).repartition(F.xxhash64(column))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for host, variants in zip(b[column], b["variants"], strict=True):
                for url in variants:
                    final, code, _ = probe(url)
                    if code is not None and 200 <= code < 300:
                        out.append((host, final, code))
                        break
            yield pd.DataFrame(out, columns=[column, "website", "code"])

    return todo.mapInPandas(run, f"`{column}` string, website string, code int")


def check_websites(sites: DataFrame, column: str, probe: Probe) -> DataFrame:
    """(column, website, code, text): per distinct site the first 200, else the first answer, else the last error."""
    todo = sites.select(column).where(F.col(column).isNotNull()).distinct().withColumn("variants", u.probe_variants(column)).repartition(F.xxhash64(column))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for site, variants in zip(b[column], b["variants"], strict=True):
                answers = []
                for url in variants:
                    answers.append(probe(url))
                    if answers[-1][1] == 200:
                        break
                good = next((a for a in answers if a[1] == 200), None) or next((a for a in answers if a[1] is not None), None)
                if good:
                    out.append((site, good[0], str(good[1])))
                elif answers:
                    out.append((site, None, answers[-1][2] or "ERROR"))
            yield pd.DataFrame(out, columns=[column, "website", "code"])

    checked = todo.mapInPandas(run, f"`{column}` string, website string, code string")
    number = F.expr("try_cast(code as int)")
    return checked.withColumn("text", F.when(number.isNotNull(), c.status_text(number)).otherwise("Connection failed"))


def search(organisations: DataFrame, client: Callable[[str], tuple[int, dict, float | None]], spacing: float = 1.0, tries: int = 4, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(Organisation_Name, Rank, URL, Title, Description): results per distinct organisation. One partition: the service allows
    one request per ``spacing`` seconds in all; 429 is repeated after its Retry-After or 2, 4, 8 ... seconds."""
    todo = organisations.select("Organisation_Name").where("Organisation_Name is not null").distinct().coalesce(1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for name in b["Organisation_Name"]:
                data: dict = {}
                for k in range(tries):
                    status, data, wait = client(name)
                    if status != 429:
                        break
                    sleep(wait if wait is not None else 2.0 ** (k + 1))
                for rank, r in enumerate(data.get("web", {}).get("results", []), 1):
                    out.append((name, rank, r.get("url", ""), r.get("title", ""), r.get("description", "")))
                sleep(spacing)
            yield pd.DataFrame(out, columns=["Organisation_Name", "Rank", "URL", "Title", "Description"])

    return todo.mapInPandas(run, "Organisation_Name string, Rank int, URL string, Title string, Description string")


def fetch_pages(pages: DataFrame, known: DataFrame, fetch: Callable[[str], tuple[str, int, str, str]], tries: int = 2, most: int = 500_000, pause: float = 1.5, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(url, html, status): pages that ``known`` doesn't have. Kept are 200 answers of type HTML from the same host that are no
    error page, cut at ``most`` bytes (a broken last character is dropped); 5xx and errors of the client are tried again
    after ``pause`` seconds, a page whose last try fails is left out."""
    todo = pages.select("url").distinct().where(~u.skippable("url") & ~u.is_directory("url")).join(known.select("url"), "url", "left_anti").repartition(F.xxhash64("url"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for url in b["url"]:
                answer = None
                for k in range(tries):
                    if k:
                        sleep(pause)
                    try:
                        answer = fetch(url)
                    except Exception:  # noqa: BLE001, S112 - whatever a client raises is a failed try
                        continue
                    if answer[1] < 500:
                        break
                if answer is not None:
                    final, status, kind, body = answer
                    out.append((url, final, status, kind, body.encode("utf-8", "replace")[:most].decode("utf-8", "ignore")))
            yield pd.DataFrame(out, columns=["url", "final", "status", "kind", "html"])

    got = todo.mapInPandas(run, "url string, final string, status int, kind string, html string")
    whole = got.where((F.col("status") == 200) & F.col("kind").contains("text/html") & (u.bare_host("final") == u.bare_host("url")))
    return parsed_pages(whole.withColumn("_html", F.col("html")), "_html").where(~is_soft_error(F.col("doc"))).select("url", "html", "status")
