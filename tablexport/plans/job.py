"""Export job definition: one frozen dataclass instead of CLI + properties.

Defaults follow the original tool's code (not its sample file): snappy,
unlimited file size, fetch size 2000, increment factor 50, suffix
``__dt_str`` with conversion off.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from .split_spec import SplitSpec

# Codecs accepted by the sink, and the default tuning numbers.
CODECS = ("null", "snappy", "deflate")
DEFAULT_FETCH_SIZE = 2000
DEFAULT_INCREMENT_FACTOR = 50
DEFAULT_BALANCED_CHUNKS = 256
DEFAULT_UNION_BATCH = 100
DEFAULT_DATETIME_SUFFIX = "__dt_str"
DEFAULT_FILENAME_PATTERN = "%{SCHEMA}.%{TABLE}.avro"
DEFAULT_COMMIT_CHUNKS = 256
DEFAULT_MANIFEST_CHUNKS = 10_000
DEFAULT_RETRY_WAITS = (5, 25, 125, 625)


@dataclass(frozen=True)
class ExportJob:
    destination: str
    catalog: str | None = None
    schemas: tuple[str, ...] = ()  # whitelist, empty = all
    tables: tuple[str, ...] = ()  # whitelist of schema.table, empty = all
    table_priorities: tuple[str, ...] = ()  # schema.table, exported first
    tables_split: tuple[str, ...] = ()  # schema.table: balanced split wanted
    unionize: tuple[str, ...] = ()  # schema.table: UNION batches of chunk queries
    table_exclusions: tuple[str, ...] = ()  # regexes, case-insensitive full match on schema.table
    column_exclusions: tuple[str, ...] = ()  # regexes, case-insensitive full match on schema.table.column
    split_strategies: tuple[str, ...] = ()  # strategy strings, see split_spec
    primary_keys: dict = field(default_factory=dict)  # table -> [columns] (file sources have no declared keys)
    partition_columns: dict = field(default_factory=dict)  # table -> [part, subpart]
    pre_sql: tuple[str, ...] = ()
    post_sql: tuple[str, ...] = ()
    flavor: str = "sqlserver"  # sqlserver | oracle: picks the datetime text form
    string_datetime: bool = False
    string_datetime_suffix: str = DEFAULT_DATETIME_SUFFIX
    filename_pattern: str = DEFAULT_FILENAME_PATTERN
    fetch_rows: int = DEFAULT_FETCH_SIZE
    avro_size: int = 0  # uncompressed bytes per file, 0 = unlimited
    codec: str = "snappy"
    tidy_tables: bool = True
    continue_on_exception: bool = False
    increment_factor: int = DEFAULT_INCREMENT_FACTOR
    balanced_chunks: int = DEFAULT_BALANCED_CHUNKS
    union_batch: int = DEFAULT_UNION_BATCH
    exactly_once: bool = True  # False mirrors the original chunk lists exactly (overlaps, lost rows)
    retry_waits: tuple[int, ...] = DEFAULT_RETRY_WAITS
    commit_chunks: int = DEFAULT_COMMIT_CHUNKS  # chunks to a commit of a database table (its own queries either way), 0 = the whole table
    commit_chunks_files: int = 0  # the same for files, where each commit is a scan
    max_commits: int = 0  # a run stops a table after so many commits and leaves the rest to a resumed one, 0 = no limit
    content_check: bool = False  # read every committed file again and hold it against the rows as read from the source
    manifest_chunks: int = DEFAULT_MANIFEST_CHUNKS  # a run of more chunks has them in its chunk dataset alone, not listed in job.json too
    timezone: str | None = None

    def __post_init__(self):
        if self.codec not in CODECS:
            raise ValueError(f"codec must be one of {CODECS}, got {self.codec!r}")
        if self.avro_size < 0:
            raise ValueError("avro_size must be >= 0")
        if self.flavor not in ("sqlserver", "oracle"):
            raise ValueError("flavor must be 'sqlserver' or 'oracle'")
        if self.increment_factor <= 0:
            raise ValueError("increment_factor must be positive")
        if min(self.commit_chunks, self.commit_chunks_files, self.max_commits) < 0:
            raise ValueError("commit_chunks, commit_chunks_files and max_commits must be >= 0")
        if self.fetch_rows <= 0:
            raise ValueError("fetch_rows must be positive")
        for s in self.split_strategies:
            SplitSpec.parse(s)

    @property
    def specs(self) -> list[SplitSpec]:
        return [SplitSpec.parse(s) for s in self.split_strategies]

    def specs_for(self, schema: str | None, table: str) -> list[SplitSpec]:
        return [s for s in self.specs if s.matches_table(schema, table)]

    def to_dict(self) -> dict:
        d = asdict(self)
        d["retry_waits"] = list(self.retry_waits)
        return d
