"""WAV payloads built from columns, and their headers read by a walk over the chunks; Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _little_endian(value: Column, size: int) -> Column:
    digits = F.lpad(F.hex(value.cast("long")), 2 * size, "0")
    pairs = [F.substring(digits, 2 * i + 1, 2) for i in reversed(range(size))]
    return F.unhex(F.concat(*pairs))


def wav_bytes(data: Column, rate: Column, channels: int = 1, width: int = 2) -> Column:
    """A PCM WAV file around raw sample bytes."""
    size = F.octet_length(data)
    text = lambda s: F.encode(F.lit(s), "UTF-8")
    block = channels * width
    return F.concat(
        text("RIFF"), _little_endian(size + 36, 4), text("WAVEfmt "), _little_endian(F.lit(16), 4),
        _little_endian(F.lit(1), 2), _little_endian(F.lit(channels), 2), _little_endian(rate, 4),
        _little_endian(rate * block, 4), _little_endian(F.lit(block), 2),
        _little_endian(F.lit(8 * width), 2), text("data"), _little_endian(size, 4), data,
    )


# Format tags of PCM and of the extensible header, and the PCM sub-format.
PCM, EXTENSIBLE = 1, 0xFFFE
PCM_SUBFORMAT = "0100000000001000800000AA00389B71"
# Chunks that may stand in front of the samples.
MOST_CHUNKS = 64


def _bytes(payload: Column, at: Column, size: int) -> Column:
    # No payload reaches past the greatest place a substring can start at.
    return F.hex(F.substring(payload, F.least(at + 1, F.lit(2**31 - 1)).cast("int"), F.lit(size)))


def _number(payload: Column, at: Column, size: int) -> Column:
    """The little-endian number at a place; null past the end."""
    digits = _bytes(payload, at, size)
    pairs = [F.substring(digits, 2 * i + 1, 2) for i in reversed(range(size))]
    return F.when(F.length(digits) == 2 * size, F.conv(F.concat(*pairs), 16, 10).cast("long"))


def wav_header(payload: Column, most_chunks: int = MOST_CHUNKS) -> Column:
    """``struct(sample_rate, channels, sample_width, frames)`` of a PCM WAV payload.

    The chunks are walked from the start: any others may come before ``fmt `` and between it and
    ``data``, at most ``most_chunks`` in all. ``frames`` follows from the declared size, also where the
    samples are cut off. Null for a null or empty payload, another format, a header that is cut off, a
    ``data`` chunk without ``fmt ``, or none.
    """
    length = F.octet_length(payload).cast("long")
    unknown = F.lit(None).cast("long")
    start = F.struct(
        F.lit(12).cast("long").alias("at"), unknown.alias("rate"), unknown.alias("channels"), unknown.alias("width"),
        unknown.alias("size"), F.lit(False).alias("over"))

    def step(state: Column, _: Column) -> Column:
        at = state["at"]
        name, size = _bytes(payload, at, 4), _number(payload, at + 4, 4)
        body = at + 8
        tag = _number(payload, body, 2)
        pcm = (tag == PCM) | ((tag == EXTENSIBLE) & (size >= 40) & (_bytes(payload, body + 24, 16) == PCM_SUBFORMAT))
        is_format, is_data = name == "666D7420", name == "64617461"
        good = is_format & (size >= 16) & pcm & (body + 16 <= length)

        def taken(value: Column, before: Column) -> Column:
            return F.when(is_format, F.when(good, value)).otherwise(before)

        after = F.struct(
            (body + size + size % 2).alias("at"), taken(_number(payload, body + 4, 4), state["rate"]).alias("rate"),
            taken(_number(payload, body + 2, 2), state["channels"]).alias("channels"),
            taken(F.floor((_number(payload, body + 14, 2) + 7) / 8), state["width"]).alias("width"),
            F.when(is_data, size).alias("size"),
            F.coalesce(is_data | (is_format & ~good), F.lit(False)).alias("over"))
        return F.when(state["over"] | size.isNull() | (at < 0), state).otherwise(after)

    # A chunk takes eight bytes at least, so short payloads are walked in few steps.
    steps = F.least(F.lit(most_chunks).cast("long"), F.floor(length / 8)).cast("int")
    found = F.aggregate(F.sequence(F.lit(0), F.greatest(steps, F.lit(0))), start, step)
    riff = (_bytes(payload, F.lit(0), 4) == "52494646") & (_bytes(payload, F.lit(8), 4) == "57415645")

    def facts(state: Column) -> Column:
        frame = state["channels"] * state["width"]
        known = (frame > 0) & state["size"].isNotNull()
        values = state["rate"], state["channels"], state["width"], F.floor(state["size"] / F.nullif(frame, F.lit(0)))
        names = "sample_rate", "channels", "sample_width", "frames"
        return F.struct(*[F.when(known, v).cast("long").alias(n) for n, v in zip(names, values)])

    # Within the lambda the walk is one value; used as a column it would be repeated for every field.
    return F.get(F.transform(F.array(F.when(riff, found)), facts), F.lit(0))
