"""Live paged source: the school API read as a Spark data source.

``spark.read.format("school_pages")`` fetches pages in parallel, one input
partition per range of pages, instead of one request after another on a
single worker. Each row is one page: ``page`` and its ``results`` array, the
same shape as a landed page line, so ``pages.read_pages`` logic (posexplode,
flatten, decode) applies unchanged.

Every page is read, whatever is known up front. The number of pages
(``pages``, or ``metadata.total`` of the first page: one or two requests on
the driver) only deals the pages to partitions; the last partition reads on
until a page is empty or absent, so a stale number loses nothing. Without
either, one partition reads until then. Pages may be numbered from 0 or 1:
page 0 is tried first, unless ``first_page`` says where to start.

Three forms share the requests:

* ``format("school_pages")``: one row a page;
* ``format("school_pages_stream")``: the same rows as they appear. The
  offset is a place in the sequence of records (page, record), so a stream
  resumes on the very record where it stopped, also within a last page that
  has grown since. The end is found by a galloping and then a binary search
  for the last page with records, so it costs a logarithm of the pages;
* ``format("school_records")``: one row a record under the plain column
  names. Filters on the columns of ``REQUEST_FILTERS`` go into the request
  (``pushFilters``), so pages of other states or types are never fetched;
  all other filters stay with Spark.

Options: ``url`` (template containing ``{page}``; any scheme ``urllib``
opens, ``file://`` included), ``fields`` (comma list of API keys, default
all), ``per_page``, ``api_key``, ``pages``, ``first_page``,
``pages_per_partition`` (default 1), ``timeout``, ``retries``, ``backoff``.
Fields, page size and key are part of the request: they fill the template's
``{fields}``, ``{per_page}`` and ``{api_key}``, and those that an http
template does not mention are added as query parameters.
"""

from __future__ import annotations

import http.client
import itertools
import json
import time
import urllib.error
import urllib.parse
import urllib.request

from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, In,
                                    InputPartition, IsNotNull)

from campuslens.schemas import API_FIELDS, page_schema

# ---------------------------------------------------------------------------
# Request parameters of the source system's client.
# ---------------------------------------------------------------------------
PER_PAGE = 100
TIMEOUT_SECONDS = 30
RETRIES = 5
BACKOFF_FACTOR = 2
RETRY_STATUSES = (429, 500, 502, 503, 504)
# Columns whose equality the API answers exactly, with their parameter names;
# several values of one go into a comma list.
REQUEST_FILTERS = {"school_id": "id", "state": "school.state", "ownership": "school.ownership",
                   "carnegie_basic": "school.carnegie_basic", "carnegie_undergrad": "school.carnegie_undergrad",
                   "level": "school.institutional_characteristics.level"}
# ---------------------------------------------------------------------------


def is_absent(err: Exception) -> bool:
    """Whether a request failed because there is no such page."""
    if isinstance(err, urllib.error.HTTPError):
        return err.code == 404
    return isinstance(getattr(err, "reason", None), FileNotFoundError)


def fetch_json(url: str, timeout: float = TIMEOUT_SECONDS, retries: int = RETRIES,
               backoff: float = BACKOFF_FACTOR) -> dict:
    """GET one page; retry transient failures with exponential back-off."""
    attempt = 0
    while True:
        try:
            with urllib.request.urlopen(url, timeout=timeout) as resp:
                return json.loads(resp.read().decode("utf-8"))
        except urllib.error.HTTPError as err:
            if err.code not in RETRY_STATUSES or attempt >= retries:
                raise
        except (OSError, http.client.HTTPException) as err:
            # no connection, a timeout, or a connection that broke in the body
            if attempt >= retries or is_absent(err):
                raise
        attempt += 1
        time.sleep(backoff * 2 ** (attempt - 1))


class PageRange(InputPartition):
    """Pages first..last; the range that ``reads_on`` goes past its last page."""

    def __init__(self, first: int, last: int, reads_on: bool):
        super().__init__((first, last, reads_on))
        self.first, self.last, self.reads_on = first, last, reads_on


class Requests:
    """The pages of one API url: how they are asked for, and where they begin."""

    def __init__(self, options: dict, fields: list[str]):
        self.url = options["url"]
        self.per_page = int(options.get("per_page", PER_PAGE))
        self.api_key = options.get("api_key")
        self.per_partition = int(options.get("pages_per_partition", 1))
        self.timeout = float(options.get("timeout", TIMEOUT_SECONDS))
        self.retries = int(options.get("retries", RETRIES))
        self.backoff = float(options.get("backoff", BACKOFF_FACTOR))
        self.fields = fields
        self.first_page, self.claimed = options.get("first_page"), options.get("pages")
        self.chosen: dict = {}

    def page_url(self, page: int) -> str:
        values = {"page": page, "fields": ",".join(self.fields), "per_page": self.per_page,
                  "api_key": self.api_key or ""}
        # a template names a column to choose by; without a choice it is asked for "all"
        columns = {c: self.chosen.get(c, "all") for c in REQUEST_FILTERS if "{" + c + "}" in self.url}
        url = self.url.format(**values, **{c: urllib.parse.quote(v) for c, v in columns.items()})
        if urllib.parse.urlsplit(url).scheme not in ("http", "https"):
            return url
        more = {k: v for k, v in values.items() if "{" + k + "}" not in self.url and v != ""}
        more |= {REQUEST_FILTERS[c]: v for c, v in self.chosen.items() if c not in columns}
        return url + ("&" if "?" in url else "?") + urllib.parse.urlencode(more) if more else url

    def _get(self, page: int) -> dict:
        return fetch_json(self.page_url(page), self.timeout, self.retries, self.backoff)

    def records(self, page: int) -> list:
        """The records of a page; none if there is no such page."""
        try:
            return self._get(page).get("results") or []
        except (OSError, http.client.HTTPException) as err:
            if is_absent(err):
                return []
            raise

    def rows(self, results: list) -> list[tuple]:
        return [tuple(rec.get(k) for k in self.fields) for rec in results]

    def locate(self) -> None:
        """Find the first page and, as far as the API tells, how many there are."""
        self.first, head = (int(self.first_page), None) if self.first_page is not None else self._base()
        self.total = self._total(head)
        if self.claimed is not None:
            self.pages = int(self.claimed)
        else:
            self.pages = -(-self.total // int(self._meta.get("per_page") or self.per_page)) if self.total is not None else 0

    def _base(self) -> tuple[int, dict | None]:
        """The number of the first page, and that page if it was fetched."""
        try:
            head = self._get(0)
        except (OSError, http.client.HTTPException) as err:
            if not is_absent(err):
                raise
            return 1, None
        if not head.get("results") or (head.get("metadata") or {}).get("page") == 1:
            return 1, None
        return 0, head

    def _total(self, head: dict | None) -> int | None:
        if head is None:
            try:
                head = self._get(self.first)
            except (OSError, http.client.HTTPException) as err:
                if not is_absent(err):
                    raise
                return None
        self._meta = head.get("metadata") or {}
        return int(self._meta["total"]) if self._meta.get("total") is not None else None

    def ranges(self) -> list[PageRange]:
        last = self.first + max(self.pages, 1) - 1
        return [PageRange(p, min(p + self.per_partition - 1, last), p + self.per_partition > last)
                for p in range(self.first, last + 1, self.per_partition)]

    def read_range(self, partition: PageRange):
        """(page, records) of a range's pages."""
        page = partition.first
        while page <= partition.last or partition.reads_on:
            beyond = page > partition.last or self.pages == 0
            try:
                results = self._get(page).get("results") or []
            except (OSError, http.client.HTTPException) as err:
                if beyond and is_absent(err):
                    return
                raise
            if beyond and not results:
                return
            yield (page, self.rows(results))
            page += 1


class SchoolPagesReader(DataSourceReader):
    def __init__(self, options: dict, fields: list[str]):
        self.requests = Requests(options, fields)
        self.requests.locate()

    def partitions(self):
        return self.requests.ranges()

    def read(self, partition: PageRange):
        yield from self.requests.read_range(partition)


class PageSlice(InputPartition):
    """Pages first..last, from record ``skip`` of the first up to record ``end`` of the last (None: whole)."""

    def __init__(self, first: int, last: int, skip: int, end: int | None):
        super().__init__((first, last, skip, end))
        self.first, self.last, self.skip, self.end = first, last, skip, end


class SchoolPagesStreamReader(DataSourceStreamReader):
    """Offsets are {"page", "record"}: the next record to read.

    Pages only grow at the end of the sequence: a page before the last one
    is full. A replayed range reads the same records; a page that has lost
    some of them since is an error.
    """

    def __init__(self, options: dict, fields: list[str]):
        self.requests = Requests(options, fields)
        self.first = self.known = None

    def _first(self) -> int:
        if self.first is None:
            first = self.requests.first_page
            self.first = int(first) if first is not None else self.requests._base()[0]
        return self.first

    def initialOffset(self) -> dict:
        return {"page": self._first(), "record": 0}

    def latestOffset(self) -> dict:
        """Just behind the last record of the last page that has any."""
        lo = self._first() if self.known is None else self.known  # a page that had records
        n = len(self.requests.records(lo))
        if not n:
            return {"page": lo, "record": 0}
        step, hi = 1, None  # lo has records, hi has none
        while hi is None:
            found = len(self.requests.records(lo + step))
            if found:
                lo, n, step = lo + step, found, step * 2
            else:
                hi = lo + step
        while hi - lo > 1:
            middle = (lo + hi) // 2
            found = len(self.requests.records(middle))
            if found:
                lo, n = middle, found
            else:
                hi = middle
        self.known = lo  # the search goes on from here
        return {"page": lo, "record": n}

    def partitions(self, start: dict, end: dict):
        if (start["page"], start["record"]) >= (end["page"], end["record"]):
            return []
        out, by = [], self.requests.per_partition
        for p in range(start["page"], end["page"] + 1, by):
            last = min(p + by - 1, end["page"])
            out.append(PageSlice(p, last, start["record"] if p == start["page"] else 0,
                                 end["record"] if last == end["page"] else None))
        return out

    def read(self, partition: PageSlice):
        for page in range(partition.first, partition.last + 1):
            results = self.requests.records(page)
            skip = partition.skip if page == partition.first else 0
            end = partition.end if page == partition.last and partition.end is not None else len(results)
            if len(results) < max(end, skip) or not results:
                raise ValueError(f"page {page} has {len(results)} records, {max(end, skip, 1)} were there before")
            if skip < end:
                yield (page, skip, self.requests.rows(results[skip:end]))


class SchoolPagesDataSource(DataSource):
    """``format("school_pages")``: one row per API page."""

    @classmethod
    def name(cls) -> str:
        return "school_pages"

    def _fields(self) -> list[str]:
        wanted = self.options.get("fields")
        if not wanted:
            return [key for key, _, _ in API_FIELDS]
        chosen = {f.strip() for f in wanted.split(",")}
        return [key for key, _, _ in API_FIELDS if key in chosen]

    def schema(self):
        return page_schema(self._fields(), with_page=True)

    def reader(self, schema):
        return SchoolPagesReader(dict(self.options), self._fields())


class SchoolPagesStream(SchoolPagesDataSource):
    """``format("school_pages_stream")``: page rows as they appear, with the place of their first record."""

    @classmethod
    def name(cls) -> str:
        return "school_pages_stream"

    def schema(self):
        fields = page_schema(self._fields(), with_page=True).fields
        return T.StructType([fields[0], T.StructField("start", T.IntegerType(), True), *fields[1:]])

    def streamReader(self, schema):
        return SchoolPagesStreamReader(dict(self.options), self._fields())


class SchoolRecordsReader(DataSourceReader):
    """Records of every page, of the chosen values only where filters name them."""

    def __init__(self, options: dict, fields: list[str]):
        self.requests = Requests(options, fields)
        self.choices: dict[str, list] = {}
        url = self.requests.url  # a template that is no http address can be asked only by the columns it names
        self.asked_by = [c for c in REQUEST_FILTERS if "{" + c + "}" in url
                         or urllib.parse.urlsplit(url).scheme in ("http", "https")]

    def pushFilters(self, filters):
        """Take equalities of ``REQUEST_FILTERS`` into the request; give the others back."""
        taken = []
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in self.asked_by and isinstance(f, (EqualTo, In)):
                values = [f.value] if isinstance(f, EqualTo) else list(f.value)
                values = list(dict.fromkeys(v for v in values if v is not None))
                held = self.choices.get(column)
                self.choices[column] = values if held is None else [v for v in held if v in values]
                taken.append(f)
        for f in filters:
            # a chosen value is not null, so that test goes as well
            if f not in taken and not (isinstance(f, IsNotNull) and f.attribute[0] in self.choices):
                yield f

    def _series(self) -> list[dict]:
        """One series of pages a combination of values; http requests take their values as a comma list."""
        if any(not v for v in self.choices.values()):
            return []
        if urllib.parse.urlsplit(self.requests.url).scheme in ("http", "https"):
            return [{c: ",".join(map(str, v)) for c, v in self.choices.items()}]
        return [dict(zip(self.choices, map(str, v))) for v in itertools.product(*self.choices.values())]

    def partitions(self):
        out = []
        for chosen in self._series():
            self.requests.chosen = chosen
            self.requests.locate()
            for r in self.requests.ranges():
                r.chosen, r.pages = chosen, self.requests.pages
                out.append(r)
        # without partitions Spark would ask for one of its own: an empty range reads nothing
        return out or [PageRange(0, -1, False)]

    def read(self, partition: PageRange):
        if partition.last < partition.first:
            return
        self.requests.chosen, self.requests.pages = partition.chosen, partition.pages
        for page, rows in self.requests.read_range(partition):
            for pos, row in enumerate(rows):
                yield (page, pos, *row)


class SchoolRecordsDataSource(SchoolPagesDataSource):
    """``format("school_records")``: one row per record, plain column names."""

    @classmethod
    def name(cls) -> str:
        return "school_records"

    def schema(self):
        kinds = {key: (plain, kind) for key, plain, kind in API_FIELDS}
        return T.StructType([T.StructField("page", T.LongType()), T.StructField("pos", T.LongType()),
                             *[T.StructField(*kinds[key]) for key in self._fields()]])

    def reader(self, schema):
        return SchoolRecordsReader(dict(self.options), self._fields())


def register(spark) -> None:
    for source in (SchoolPagesDataSource, SchoolPagesStream, SchoolRecordsDataSource):
        spark.dataSource.register(source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def _reader(spark, url: str, options: dict):
    register(spark)
    reader = spark.read.format("school_pages").option("url", url)
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader


def read_api(spark, url: str, **options):
    """Raw school records fetched page-parallel from ``url`` (a ``{page}`` template)."""
    from campuslens.operators.decode import flatten_record
    from campuslens.sources.pages import unnest_pages

    return flatten_record(unnest_pages(_reader(spark, url, options).load()))


def read_records(spark, url: str, **options):
    """Raw school records of ``format("school_records")``; filters on it are pushed into the requests."""
    register(spark)
    reader = spark.read.format("school_records").option("url", url)
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load()


def stream_pages(spark, url: str, **options):
    """The page rows of ``url`` as a stream that resumes on the record where it stopped."""
    register(spark)
    reader = spark.readStream.format("school_pages_stream").option("url", url)
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load()


def land_api(spark, url: str, path: str, **options) -> int:
    """Fetch every page and land it as it came: one JSON line a page, no shuffle.

    Returns the records landed; fewer than the API's own total is an error.
    """
    from pyspark.sql import functions as F

    pages = _reader(spark, url, options).load()
    pages.write.json(path)
    landed = spark.read.schema(pages.schema).json(path).agg(
        F.coalesce(F.sum(F.size("results")), F.lit(0)).alias("n")).first()["n"]
    requests = Requests({"url": url, **{k: str(v) for k, v in options.items()}}, [])
    requests.locate()
    total = requests.total
    if total is not None and landed < total:
        raise ValueError(f"landed {landed} records of {total}")
    return landed
