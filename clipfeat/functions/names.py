"""File names, ledger lines and probe logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a feature file's name has after the id.
SUFFIXES = {"visual": "_one_peace_video_finetune.npy", "audio": "_one_peace_audio.npy"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def feature_name(video_id, modality) -> Column:
    """The file name of an id and a modality; null for an unknown modality."""
    suffix = F.when(_col(modality) == "visual", SUFFIXES["visual"]).when(_col(modality) == "audio", SUFFIXES["audio"])
    return F.concat(_col(video_id), suffix)


def parse_feature_name(name) -> Column:
    """struct(video_id, modality); nulls if the name has none of the suffixes."""
    c = _col(name)
    of = lambda m: c.endswith(SUFFIXES[m])
    cut = lambda m: F.substr(c, F.lit(1), F.length(c) - len(SUFFIXES[m]))
    return F.struct(F.when(of("visual"), cut("visual")).when(of("audio"), cut("audio")).alias("video_id"), F.when(of("visual"), "visual").when(of("audio"), "audio").alias("modality"))


def stem(name, prefix: str = "") -> Column:
    """The name without its last extension and without ``prefix``."""
    return F.substr(F.regexp_replace(_col(name), r"(?<=.)\.[^.]*$", ""), F.lit(len(prefix) + 1))


def done_line_to_id(line, suffix: str) -> Column:
    """The id of a ledger line: an id, a file name or a path, perhaps quoted, perhaps followed by a tab and more; null if blank."""
    name = F.regexp_replace(_col(line), "^﻿", "")
    name = F.btrim(F.btrim(F.substring_index(name, "\t", 1), F.lit(" \r\n\x0b\x0c")), F.lit("\"'"))
    name = F.substring_index(F.translate(name, "\\", "/"), "/", -1)
    out = name
    for ext in (".wav", ".mp4", suffix):  # the last one is asked first
        out = F.when(name.endswith(ext), F.substr(name, F.lit(1), F.length(name) - len(ext))).otherwise(out)
    return F.when(F.length(F.trim(_col(line))) > 0, out)


def parse_probe(log) -> Column:
    """struct(duration, width, height, sample_rate) from the text that a media probe prints; null where a part is absent.

    The log is a line for each fact, its parts between commas: one begins with the duration, and those of a stream of pictures or
    sound have its size or rate."""
    lines = F.split(_col(log), r"[\r\n]+")
    parts = lambda wanted: F.flatten(F.transform(F.filter(lines, wanted), lambda x: F.transform(F.split(x, ","), lambda p: F.trim(p))))
    first = lambda wanted, part: F.try_element_at(F.filter(parts(wanted), part), F.lit(1))
    stream = lambda kind: lambda x: x.contains("Stream #") & x.contains(f"{kind}: ")
    clock = F.split(F.substring_index(first(lambda x: x.contains("Duration:"), lambda p: p.startswith("Duration:")), "Duration:", -1), ":")
    unit = lambda k, kind: F.trim(F.try_element_at(clock, F.lit(k))).try_cast(kind)
    size = F.split(F.split_part(first(stream("Video"), lambda p: p.rlike("^[0-9]+x[0-9]+( |$)")), F.lit(" "), F.lit(1)), "x")
    rate = F.split_part(first(stream("Audio"), lambda p: p.rlike("^[0-9]+ Hz$")), F.lit(" "), F.lit(1))
    return F.struct(
        (unit(1, "long") * 3600 + unit(2, "long") * 60 + unit(3, "double")).alias("duration"),
        F.try_element_at(size, F.lit(1)).try_cast("int").alias("width"), F.try_element_at(size, F.lit(2)).try_cast("int").alias("height"), rate.try_cast("int").alias("sample_rate"),
    )
