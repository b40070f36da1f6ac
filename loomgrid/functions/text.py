"""Text functions: names, paths, templates and episode numbers in messages."""

from __future__ import annotations

import re
import shlex

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of names and of episode numbers in messages.
ENTITY = r"^[A-Za-z_][A-Za-z0-9_]*$"
PREFIX = r"^[A-Za-z0-9][A-Za-z0-9_.-]*$"
EPISODE = r"(?i)\bepisode\s+(\d+)\b"
EPISODE_LIST = r"(?i)\bepisode\(s\).*:\s*\[([0-9,\s]+)\]\s*$"


def valid_entity(name: Column) -> Column:
    return F.coalesce(name.rlike(ENTITY), F.lit(False))


def valid_topic(name: Column) -> Column:
    """Recorded topics are absolute and not the root."""
    return F.coalesce(F.startswith(name, F.lit("/")) & (name != "/"), F.lit(False))


def valid_prefix(name: Column) -> Column:
    return F.coalesce(name.rlike(PREFIX), F.lit(False))


def message_episodes(message: Column) -> Column:
    """Every ``episode N`` of a message and a closing ``episode(s) ...: [n, n]`` list, sorted and distinct."""
    single = F.transform(F.regexp_extract_all(message, F.lit(EPISODE), F.lit(1)), lambda x: x.cast("int"))
    listed = F.filter(F.transform(F.split(F.regexp_extract(message, EPISODE_LIST, 1), ","), lambda x: F.btrim(x, F.lit(" \t\r\n"))), lambda x: x != "")
    many = F.transform(listed, lambda x: x.cast("int"))
    return F.array_sort(F.array_distinct(F.concat(single, many)))


def repository_slug(name: Column) -> Column:
    """``local/<name>`` with runs of other characters made one dash; ``dataset`` if nothing is left."""
    token = F.btrim(F.regexp_replace(name, r"[^A-Za-z0-9_.-]+", "-"), F.lit("-."))
    return F.concat(F.lit("local/"), F.coalesce(F.nullif(token, F.lit("")), F.lit("dataset")))


def topic_path(base: Column, *parts: Column) -> Column:
    """Joined topic names: empty segments dropped, absolute if the first is."""
    segments = F.filter(F.split(F.concat_ws("/", base, *parts), "/"), lambda x: x != "")
    return F.concat(F.when(F.startswith(base, F.lit("/")), F.lit("/")).otherwise(F.lit("")), F.array_join(segments, "/"))


def video_path(template: str, key: Column, chunk: Column, file: Column) -> Column:
    """A path template with {video_key}, {chunk_index} and {file_index}; ``:03d``-like widths are honoured."""
    out: list[Column] = []
    for literal, field, width in re.findall(r"([^{]*)(?:\{(\w+)(?::0?(\d+)d)?\})?", template):
        if literal:
            out.append(F.lit(literal))
        if field:
            value = {"video_key": key, "chunk_index": chunk, "file_index": file}[field].cast("string")
            out.append(F.when(F.length(value) < int(width), F.lpad(value, int(width), "0")).otherwise(value) if width else value)
    return F.concat(*out)


def stage_name(base: Column, number: Column, stage: Column) -> Column:
    """Names of derived datasets: the base, a two-digit number and the stage."""
    return F.format_string("%s_%02d_%s", base, number, stage)


def assignment(text: Column) -> Column:
    """``ID=VALUE`` at the first equals sign, both trimmed: struct (id, value); null if either is empty."""
    left, right = F.trim(F.substring_index(text, "=", 1)), F.trim(F.regexp_extract(text, r"^[^=]*=(?s)(.*)$", 1))
    return F.when(F.contains(text, F.lit("=")) & (left != "") & (right != ""), F.struct(left.alias("id"), right.alias("value")))


def parse_assignments(items: list[str], what: str = "mapping") -> dict[str, str]:
    """The driver's form of ``assignment``: order kept, repeated identifiers refused."""
    out: dict[str, str] = {}
    for item in items:
        key, equals, value = (x.strip() for x in item.partition("="))
        if not equals or not key or not value:
            raise ValueError(f"{what} must be ID=VALUE: {item!r}")
        if key in out:
            raise ValueError(f"{what} repeats {key!r}")
        out[key] = value
    return out


def parse_command(item: str, reserved: frozenset[str] = frozenset({"--report-dir", "--result-file", "--fail-on"})) -> tuple[str, list[str]]:
    """``NAME=COMMAND`` into a name and an argument list; options that the workflow sets itself are refused."""
    name, equals, command = item.partition("=")
    name = name.strip()
    words = shlex.split(command) if equals else []
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_-]*", name) or not words:
        raise ValueError(f"evaluator must be NAME=COMMAND: {item!r}")
    if taken := sorted(w for w in {x.partition("=")[0] for x in words} if w in reserved):
        raise ValueError(f"evaluator {name} sets {', '.join(taken)}")
    return name, words
