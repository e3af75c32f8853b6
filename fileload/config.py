"""Settings of one load job, checked on the driver before anything is launched."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from fileload.operators.records import BAD, fields, record_spec

# A letter first, so that partition discovery never reads a job id as a number.
_JOB_ID = re.compile(r"[A-Za-z][A-Za-z0-9_.-]*")

# The setting names of the loader this job replaces.
SETTING_NAMES = {
    "concreteRecordName": "record_type",
    "maxFileSize": "max_file_size",
    "detailOutputPath": "detail_path",
    "maxFileHandlePath": "oversize_path",
    "inputBakPath": "archive_path",
}


# What a written row has besides its record's columns.
STAMPS = fields(
    **{BAD: "string"},
    line_no="long",
    block="long",
    block_row="long",
    src_path="string",
    src_length="long",
    src_mtime="timestamp",
    status="string",
    n_lines="long",
    n_bytes="long",
    wave="integer",
    codec="string",
    kind="string",
)
RESERVED = {*STAMPS.names, "job_id", "record_type", "batch", "path", "length", "modificationTime"}


def check_names(record_type: str) -> None:
    """Fields are told apart by position, so a clashing name can be changed."""
    clash = RESERVED & set(record_spec(record_type).schema.names)
    if clash:
        raise ValueError(f"record type {record_type!r} uses the reserved names {sorted(clash)}")


def check_job_id(job_id: str) -> str:
    if not _JOB_ID.fullmatch(job_id or ""):
        raise ValueError(f"job id {job_id!r} must be letters, digits, '_', '.', '-' and start with a letter")
    return job_id


@dataclass(frozen=True)
class LoadConfig:
    """``max_file_size`` is in bytes; larger inputs are listed under
    ``oversize_path`` and not loaded.  A file in the ledger counts as loaded, so
    tables of different record types need ledgers of their own.
    ``archive_path`` is used by the incremental job only.  ``layout`` names the
    fields of a manifest line and ``base_uri`` resolves paths without a scheme.
    ``max_bytes_per_file`` bounds detail files and costs a shuffle of the rows."""

    record_type: str
    max_file_size: int
    job_id: str
    detail_path: str
    ledger_path: str
    oversize_path: str | None = None
    archive_path: str | None = None
    base_uri: str | None = None
    layout: tuple[str, ...] = ("path",)
    path_col: str = "path"
    sep: str = ":"
    mode: str = "PERMISSIVE"
    max_records_per_file: int | None = None
    max_bytes_per_file: int | None = None

    def __post_init__(self):
        check_names(self.record_type)
        check_job_id(self.job_id)
        if isinstance(self.max_file_size, bool) or not isinstance(self.max_file_size, int):
            raise ValueError(f"max_file_size must be an integer, not {self.max_file_size!r}")
        if not -(1 << 63) <= self.max_file_size < 1 << 63:
            raise ValueError(f"max_file_size {self.max_file_size} does not fit in 64 bits")
        if self.path_col not in self.layout:
            raise ValueError(f"layout {self.layout} has no column {self.path_col!r}")

    @classmethod
    def from_settings(cls, settings: Mapping[str, str], **kwargs) -> LoadConfig:
        """Build from string settings.  The record name and the size limit are
        required, the paths may be absent."""
        known = {name: settings.get(key) for key, name in SETTING_NAMES.items()}
        limit = known["max_file_size"]
        if limit is None or not re.fullmatch(r"[+-]?[0-9]+", limit):
            raise ValueError(f"maxFileSize must be a whole number, not {limit!r}")
        known["max_file_size"] = int(limit)
        if known["record_type"] is None:
            raise KeyError("concreteRecordName")
        return cls(**{name: value for name, value in known.items() if value is not None}, **kwargs)
