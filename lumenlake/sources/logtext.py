"""Log text to typed landmark events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# An application line has four parts: time with milliseconds after a comma, origin, level, message.
PARTS = " - "
SERVER_LINE = r"(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3}) UTC \[\d+\] LOG:  (.*)$"


@dataclass(frozen=True)
class Phrases:
    """How each landmark starts.  Entries ending in a group capture a number."""

    load_created: str
    schema_valid: str
    schema_origin: str
    reading: str
    clearing: str
    cleared: str
    history: str
    copied: str
    finished: str
    finished_rows: str
    attempt: str
    connected: str
    connect_failed: str
    retry_origin: str
    shutdown: str = "received fast shutdown request"
    ready: str = "database system is ready to accept connections"


# The phrases of the published logs, and of the derived ones.
PUBLISHED_PHRASES = Phrases(
    load_created=r"^ID da carga criada: (\d+)",
    schema_valid="Schema validado com sucesso",
    schema_origin="validador_schema",
    reading="Lendo arquivo:",
    clearing="Limpando tabela",
    cleared="Tabela limpa",
    history="Inserindo dados na tabela hist",
    copied="Dados copiados",
    finished="Carga concluída",
    finished_rows=r"^Carga concluída com sucesso\. Registros inseridos: (\d+)",
    attempt=r"^Tentativa (\d)/3",
    connected=r"^Conexão estabelecida após 3 tentativa\(s\) em (\d+) ms",
    connect_failed=r"Falha ao conectar após 1 tentativa\(s\) em (\d+) ms: could not translate",
    retry_origin="db_utils",
)
DERIVED_PHRASES = Phrases(
    load_created=r"^Load id created: (\d+)",
    schema_valid="Schema valid",
    schema_origin="schema_check",
    reading="Reading file:",
    clearing="Clearing raw",
    cleared="Raw cleared",
    history="Writing history",
    copied="History copied",
    finished="Load finished",
    finished_rows=r"^Load finished\. Rows inserted: (\d+)",
    attempt=r"^Attempt (\d)/3",
    connected=r"^Connected after 3 attempt\(s\) in (\d+) ms",
    connect_failed=r"Connection failed after 1 attempt\(s\) in (\d+) ms: could not translate",
    retry_origin="db_utils",
)

# Load milestones in the order in which a load passes them.
MILESTONES = ["created", "schema", "reading", "clearing", "cleared", "history", "copied", "finished"]


def scan_log(spark: SparkSession, path: str | list[str], name: str = "file_name") -> DataFrame:
    """Lines with their file, split and place, which together are the log order.

    ``name`` is what orders the files: their names, or with ``file_path`` their paths.
    """
    return spark.read.text(path).select(
        F.col(f"_metadata.{name}").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Split application lines and database server lines into (ts, origin, message); drop the rest.

    Each line unfolds into one event or none.  Unfolding also keeps later
    filters above it, so the expressions run once per line.
    """
    part = F.split("line", PARTS, 4)
    stamp = F.replace(F.element_at(part, 1), F.lit(","), F.lit("."))
    # Nulls, where a line has fewer parts, make the test fail.
    timed = (F.length(stamp) == 23) & F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss.SSS")).isNotNull()
    level = F.get(part, F.lit(2)).rlike("^[A-Za-z0-9_]+$")
    origin = F.get(part, F.lit(1))
    server = lambda i: F.regexp_extract("line", SERVER_LINE, i)
    event = F.when(timed & level & origin.rlike("^[^ \t]+$"), _event(stamp, origin, F.get(part, F.lit(3)))).when(
        F.col("line").rlike(SERVER_LINE), _event(server(1), F.lit("database"), server(2))
    )
    kept = [c for c in lines.columns if c != "line"]
    return lines.select(*kept, F.inline(event))


def _event(stamp: Column, origin: Column, message: Column) -> Column:
    return F.array(F.struct(stamp.try_cast("timestamp_ntz").alias("ts"), origin.alias("origin"), message.alias("message")))


def classify(parsed: DataFrame, phrases: Phrases) -> DataFrame:
    """Keep landmark lines only: (…, ts, kind, load_id, number)."""
    origin, message = F.col("origin"), F.col("message")
    starts = lambda text: message.startswith(text)
    retry = origin == phrases.retry_origin
    kind = (
        F.when(message.rlike(phrases.load_created), "created")
        .when((origin == phrases.schema_origin) & starts(phrases.schema_valid), "schema")
        .when(starts(phrases.reading), "reading")
        .when(starts(phrases.clearing), "clearing")
        .when(starts(phrases.cleared), "cleared")
        .when(starts(phrases.history), "history")
        .when(starts(phrases.copied), "copied")
        .when(starts(phrases.finished), "finished")
        .when(retry & message.rlike(phrases.attempt), "attempt")
        .when(retry & message.rlike(phrases.connected), "connected")
        .when(message.rlike(phrases.connect_failed), "connect_failed")
        .when(message.contains(phrases.shutdown), "shutdown")
        .when(message.contains(phrases.ready), "ready")
    )
    kept = [c for c in parsed.columns if c not in ("origin", "message")]
    found = parsed.select(*parsed.columns, F.explode(F.when(kind.isNotNull(), F.array(kind))).alias("kind"))
    numbers = {
        "finished": phrases.finished_rows,
        "attempt": phrases.attempt,
        "connected": phrases.connected,
        "connect_failed": phrases.connect_failed,
    }
    number = F.coalesce(*(_number_of(kind, pattern) for kind, pattern in numbers.items()))
    return found.select(*kept, "kind", _number_of("created", phrases.load_created).alias("load_id"), number.alias("number"))


def _number_of(kind: str, pattern: str) -> Column:
    """The captured number of lines of one kind; other lines are not searched."""
    digits = F.regexp_extract("message", pattern, 1)
    return F.when((F.col("kind") == kind) & (digits != ""), digits.cast("bigint"))
