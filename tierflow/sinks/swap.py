"""Replacing days so that a driver death loses nothing. Id: SNK-3.

New days are written beside the dataset under a hidden name.  A note of the swap's own
then names them; from there on the new days count, and only directories are moved: an old
day aside, the new one into its place.  Readers take a noted day from where it still lies
staged (``scans.staged_days``); whoever writes to the dataset next finishes the moves.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

from tierflow.sources.scans import (
    SWAP_NOTE,
    _located,
    listed_directories,
    open_swaps,
    write_note,
)


def staging_path(path: str) -> str:
    """A new hidden directory beside the days of ``path``."""
    return f"{path}/_staged-{uuid.uuid4().hex}"


def note_swap(spark: SparkSession, path: str, staged: str, depth: int) -> None:
    """Announce the days below ``staged``, directories of ``depth`` levels."""
    days = listed_directories(spark, staged, depth)
    name = staged.rpartition("/")[2]
    note = {"staged": name, "days": days, "made": time.time_ns()}
    write_note(spark, f"{path}/{SWAP_NOTE.format(name.partition('-')[2])}", note)


def finish_swap(spark: SparkSession, path: str) -> bool:
    """Complete the swaps that notes announce, the oldest first; True if there were any.

    Safe to repeat after a death at any step: a staged day that is gone has been moved.
    """
    notes = open_swaps(spark, path)
    for note in notes:
        aside = note["staged"].replace("_staged-", "_old-", 1)
        for day in note["days"]:
            _replace(spark, f"{path}/{note['staged']}/{day}", f"{path}/{day}", f"{path}/{aside}/{day}")
        for name in (aside, note["staged"], note["name"]):
            delete(spark, f"{path}/{name}")
    return bool(notes)


def _replace(spark: SparkSession, staged: str, target: str, aside: str) -> None:
    if not exists(spark, staged):
        return
    if exists(spark, target):
        if exists(spark, aside):
            # The old day is aside already: this one was written since and is newer.
            delete(spark, staged)
            return
        move(spark, target, aside)
    move(spark, staged, target)


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _located(spark, path)
    return files.exists(target)


def move(spark: SparkSession, source: str, target: str) -> None:
    there, files = _located(spark, target)
    files.mkdirs(there.getParent())
    here, _ = _located(spark, source)
    if not files.rename(here, there):
        raise OSError(f"cannot move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    target, files = _located(spark, path)
    files.delete(target, True)
