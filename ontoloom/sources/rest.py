"""A REST catalogue as a data source: ``spark.read.format("rest_catalogue")``.

Options: url (of the service), acronyms (comma separated; all if it is empty),
key, limit_bytes, parallel, and what: "files" (metadata and file of each
acronym, the default) or "catalogue" (id, name, version and submission only). Each partition asks for a share of the acronyms,
with retries, and every failure is a row with its reason. ``fetch`` can be
replaced, so that tests need no network.
"""

from __future__ import annotations

import http.client
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ontoloom.functions import vocab as V

SCHEMA = (
    "id string, name string, version string, submission_id string, source_bytes bigint, status string, reason string,"
    " http_status int, filename string, content binary"
)
CATALOGUE_SCHEMA = "id string, name string, current_version string, submission_id string"
TRIES, RETRY_CODES, CHUNK = 5, (429, 504), 1 << 20
#: Seconds that a server may stay silent.
TIMEOUT = 120
#: What a request can raise: no connection, silence, a body cut short.
BROKEN = (OSError, http.client.HTTPException)

#: (url, key, limit) -> (code, headers, body); the body stops behind the limit.
Fetch = Callable[[str, str, int], tuple[int, dict, bytes]]


def http_fetch(url: str, key: str, limit: int) -> tuple[int, dict, bytes]:
    for k in range(TRIES):
        request = urllib.request.Request(url, headers={"Authorization": f"apikey token={key}"} if key else {})
        try:
            with urllib.request.urlopen(request, timeout=TIMEOUT) as r:
                length = int(r.headers.get("Content-Length") or 0)
                if limit and length > limit:
                    return r.status, dict(r.headers), b""
                parts, n = [], 0
                while data := r.read(CHUNK):
                    parts.append(data)
                    n += len(data)
                    if limit and n > limit:
                        break
                return r.status, dict(r.headers), b"".join(parts)
        except urllib.error.HTTPError as e:
            if e.code not in RETRY_CODES or k == TRIES - 1:
                return e.code, dict(e.headers), b""
            time.sleep(2**k)
    raise AssertionError


def acquire(url: str, acronym: str, key: str, limit: int, fetch: Fetch) -> tuple:
    """The row of one acronym: metadata, then latest submission, then the file."""
    name = version = ""
    submission = "NA"

    def row(status: str, reason: str, n: int = 0, code: int | None = None, filename: str | None = None, content: bytes | None = None) -> tuple:
        return acronym, name, version, submission, n, status, reason, code, filename, content

    if acronym.strip().upper() in V.GIANTS:
        return row(V.SKIPPED, "skiplist")
    try:
        code, _, body = fetch(f"{url}/ontologies/{acronym}", key, 0)
        if code != 200:
            return row(V.ERROR, "metadata_http_error", code=code)
        name = str(json.loads(body).get("name") or acronym)
        code, _, body = fetch(f"{url}/ontologies/{acronym}/latest_submission", key, 0)
        latest = json.loads(body or b"{}") if code == 200 else {}
        if "submissionId" not in latest:
            return row(V.ERROR, "no_submission")
        submission, version = str(latest["submissionId"]), str(latest.get("version") or "NA")
    except (*BROKEN, ValueError, AttributeError):
        return row(V.ERROR, "metadata_http_error")
    try:
        code, headers, body = fetch(f"{url}/ontologies/{acronym}/download", key, limit)
    except BROKEN:
        return row(V.ERROR, "download_error")
    if code in V.LICENSE_CODES:
        return row(V.ERROR, V.LICENSED, code=code)
    if code == 404:
        return row(V.ERROR, "no_download_file", code=code)
    if not 200 <= code < 300:
        return row(V.ERROR, "download_http_error", code=code)
    found = {k.lower(): v for k, v in headers.items()}
    parts = found.get("content-disposition", "").split("filename=")
    if len(parts) < 2:
        return row(V.ERROR, "not_downloadable", code=code)
    length = int(found.get("content-length") or 0)
    if limit and max(length, len(body)) > limit:
        return row(V.SKIPPED, V.TOO_LARGE, n=length if length > limit else len(body))
    return row(V.DOWNLOADED, "", n=len(body), filename=parts[1].replace('"', ""), content=body)


def _line(x: str) -> str:
    return x.replace("\n", " ").replace("\t", " ")


def listed(url: str, acronym: str, key: str, fetch: Fetch) -> tuple:
    """The catalogue's row of one acronym: name, the version's first three words, the submission; NA for what there isn't."""
    nothing = acronym, acronym, "NA", "NA"
    try:
        code, _, body = fetch(f"{url}/ontologies/{acronym}/latest_submission", key, 0)
        latest = json.loads(body or b"{}") if code == 200 else {}
        if not latest:
            return nothing
        name = _line(str((latest.get("ontology") or {}).get("name") or acronym))
        version = " ".join(_line(str(latest.get("version") or "")).split()[:3])
        return acronym, name, version or "NA", str(latest.get("submissionId") or "NA")
    except (*BROKEN, ValueError, AttributeError):
        return nothing


class _Share(InputPartition):
    def __init__(self, acronyms: list[str]):
        self.acronyms = acronyms


class RestReader(DataSourceReader):
    def __init__(self, options: dict, fetch: Fetch):
        self.url, self.key, self.fetch = options.get("url", "").rstrip("/"), options.get("key", ""), fetch
        self.limit, self.parallel = int(options.get("limit_bytes", 0)), int(options.get("parallel", 20))
        self.what = options.get("what", "files")
        self.wanted = [a.strip() for a in options.get("acronyms", "").split(",") if a.strip()]

    def partitions(self) -> list[_Share]:
        names = self.wanted
        if not names:
            _, _, body = self.fetch(f"{self.url}/analytics", self.key, 0)
            names = list(json.loads(body))
        n = max(1, min(self.parallel, len(names)))
        return [_Share(names[k::n]) for k in range(n)]

    def read(self, partition: _Share) -> Iterator[tuple]:
        for a in partition.acronyms:
            yield listed(self.url, a, self.key, self.fetch) if self.what == "catalogue" else acquire(self.url, a, self.key, self.limit, self.fetch)


class RestCatalogue(DataSource):
    fetch: Fetch = staticmethod(http_fetch)

    @classmethod
    def name(cls) -> str:
        return "rest_catalogue"

    def schema(self) -> str:
        return CATALOGUE_SCHEMA if self.options.get("what") == "catalogue" else SCHEMA

    def reader(self, schema) -> RestReader:
        return RestReader(self.options, type(self).fetch)
