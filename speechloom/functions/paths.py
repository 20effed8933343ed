"""Audio path and file name expressions."""

from __future__ import annotations

import os
import posixpath
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*"


def _names(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))


def _without_dots(path: Column) -> Column:
    folded = F.aggregate(
        _names(path),
        F.array().cast("array<string>"),
        lambda kept, name: F.when(name != "..", F.concat(kept, F.array(name)))
        .when(F.size(kept) > 0, F.slice(kept, F.lit(1), F.size(kept) - 1))
        .otherwise(kept),
    )
    return F.concat(F.lit("/"), F.array_join(folded, "/"))


def normalize_path(path: Column) -> Column:
    """Collapse ``//``, ``.`` and ``..`` of an absolute path or URI; clean paths skip the fold."""
    authority = F.regexp_extract(path, f"({_AUTHORITY})", 1)
    rest = F.regexp_replace(path, _AUTHORITY, "")
    return F.when(
        path.rlike(r"(?<!:)//|/\.|/$"), F.concat(authority, _without_dots(rest))
    ).otherwise(path)


def plain_path(path: Column, default_fs: str = "file:///") -> Column:
    """Without scheme and authority where these name the default file system, so that both forms join."""
    if default_fs.startswith("file:"):
        return F.regexp_replace(path, "^file:(//)?(?=/)", "")
    root = default_fs.rstrip("/")
    return F.when(path.startswith(root + "/"), F.substr(path, F.lit(len(root) + 1))).otherwise(path)


def absolute_dir(base_dir: str | None, working_dir: str | None = None, default_fs: str = "file:///") -> str:
    """``base_dir`` without dots, below ``working_dir`` if relative, in the form of ``plain_path``."""
    base = base_dir or working_dir or os.getcwd()
    if "://" not in base and not base.startswith(("/", "file:/")):
        base = f"{working_dir or os.getcwd()}/{base}"
    if default_fs.startswith("file:"):
        base = re.sub("^file:(//)?(?=/)", "", base)
    elif base.startswith(default_fs.rstrip("/") + "/"):
        base = base[len(default_fs.rstrip("/")):]
    authority = re.match(_AUTHORITY, base)
    root = authority.group() if authority else ""
    return root + posixpath.normpath("/" + base[len(root):].lstrip("/"))


def resolve_audio_path(
    path: Column, base_dir: str | None = None, working_dir: str | None = None, default_fs: str = "file:///"
) -> Column:
    """Absolute form of ``path``: relative ones are taken below ``base_dir``."""
    base = absolute_dir(base_dir, working_dir, default_fs)
    absolute = path.startswith("/") | path.rlike(_AUTHORITY) | path.rlike("^file:/")
    given = F.when(absolute, plain_path(path, default_fs)).otherwise(F.concat_ws("/", F.lit(base), path))
    return normalize_path(given)


def drop_extension(path: Column) -> Column:
    """Without the last extension; leading dots of a file name do not start one."""
    return F.regexp_replace(path, r"(?s)^(.*/)?(\.*[^/.][^/]*)\.[^./]*$", "$1$2")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def relative_path(path: Column, base_dir: str) -> Column:
    """Path relative to ``base_dir``, with ``..`` steps when it lies outside."""
    base = [p for p in base_dir.split("/") if p not in ("", ".")]
    names = _names(path)
    shared = F.lit(0)
    for i in range(len(base)):
        prefix = F.array(*[F.lit(p) for p in base[: i + 1]])
        shared = shared + (F.slice(names, 1, i + 1) == prefix).cast("int")
    steps = F.concat(
        F.array_repeat(F.lit(".."), F.lit(len(base)) - shared),
        F.slice(names, shared + 1, F.greatest(F.size(names), F.lit(1))),
    )
    return F.when(F.size(steps) == 0, F.lit(".")).otherwise(F.array_join(steps, "/"))


def resampled_path(
    path: Column,
    resample_dir: str,
    base_dir: str | None = None,
    working_dir: str | None = None,
    default_fs: str = "file:///",
) -> Column:
    """Where the resampled copy of an absolute ``path`` goes: its place below ``base_dir``, or its name alone."""
    rest = relative_path(path, absolute_dir(base_dir, working_dir, default_fs)) if base_dir else base_name(path)
    return F.concat(F.lit(resample_dir.rstrip("/") + "/"), drop_extension(rest), F.lit(".wav"))


def name_audio_file(
    row_idx: Column, split: str | Column | None = None, audio_format: str = "wav"
) -> Column:
    """``00000007.wav``, or ``train_00000007.wav`` when a split is given."""
    name = F.format_string(f"%08d.{audio_format}", row_idx)
    if split is None:
        return name
    return F.concat(F.lit(split) if isinstance(split, str) else split, F.lit("_"), name)


def checkpoint_name(epoch: Column, metric: Column, labelled: bool = False) -> Column:
    """``05-0.2000``, or ``epoch=05-val_wer=0.2000`` when labelled."""
    pattern = "epoch=%02d-val_wer=%.4f" if labelled else "%02d-%.4f"
    return F.format_string(pattern, epoch, metric)
