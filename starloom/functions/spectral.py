"""Fourier, Welch and wavelet features."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.names import feature, flux
from starloom.operators.series import Series

FFT_COEFFICIENTS = 100
SEGMENT = 256
FEW = 8
LINE_ROWS = 262_144

# The published parameter grids of the calculators.
WELCH_BINS = (2, 5, 8)
ENTROPY_BINS = (2, 3, 5, 10, 100)
CWT_WIDTHS = (2, 5, 10, 20)
CWT_COEFFICIENTS = 15
CWT_PEAK_WIDTHS = (1, 5)


PARTS = ("real", "imag", "abs", "angle")


def fft_coefficients(s: Series, number: int = FFT_COEFFICIENTS) -> DataFrame:
    """The first Fourier sums; coefficients beyond n/2 are null."""
    found = _first_sums(s, number) if number <= FEW else _spectrum(s, number)
    size = F.zip_with("re", "im", lambda a, b: F.sqrt(a * a + b * b))
    turn = F.zip_with("re", "im", lambda a, b: F.degrees(F.atan2(b, a)))
    found = found.select(*s.keys, F.col("re").alias("real"), F.col("im").alias("imag"), size.alias("abs"), turn.alias("angle"))
    return found.select(
        *s.keys,
        *[F.get(part, F.lit(k)).alias(feature("fft_coefficient", part, coeff=k)) for k in range(number) for part in PARTS],
    )


def _first_sums(s: Series, number: int) -> DataFrame:
    """A few coefficients as plain sums.

    The phase uses ``k * pos mod n`` so that long series keep full precision.
    """
    s = s.with_stats(_n=F.count(F.lit(1))).with_columns(_w=F.lit(2 * math.pi) / F.col("_n"))
    res, ims = [], []
    for k in range(number):
        angle = ((F.col("pos") * k) % F.col("_n")) * F.col("_w")
        known = F.max("_n") >= 2 * k
        res.append(F.when(known, F.sum(flux() * F.cos(angle))))
        ims.append(F.when(known, -F.sum(flux() * F.sin(angle))))
    return s.per_key(F.array(*res).alias("re"), F.array(*ims).alias("im"))


def fft_moments(s: Series) -> DataFrame:
    """Centroid, variance, skew and kurtosis of the magnitude spectrum."""
    found = _spectrum(s, 1)
    m1, m2, m3, m4 = [F.try_divide(F.get("s", F.lit(j)), F.get("s", F.lit(0))) for j in (1, 2, 3, 4)]
    moments = found.select(*s.keys, m1.alias("m1"), m2.alias("m2"), m3.alias("m3"), m4.alias("m4"))
    m1, m2, m3, m4 = [F.col(f"m{j}") for j in (1, 2, 3, 4)]
    var = m2 - m1 * m1
    third = m3 - 3 * m1 * m2 + 2 * F.pow(m1, F.lit(3.0))
    fourth = m4 - 4 * m1 * m3 + 6 * m1 * m1 * m2 - 3 * F.pow(m1, F.lit(4.0))
    return moments.select(
        *s.keys,
        m1.alias(feature("fft_aggregated", aggtype="centroid")),
        var.alias(feature("fft_aggregated", aggtype="variance")),
        F.when(var >= 0.5, F.try_divide(third, F.pow(var, F.lit(1.5)))).alias(
            feature("fft_aggregated", aggtype="skew")
        ),
        F.when(var >= 0.5, F.try_divide(fourth, var * var)).alias(feature("fft_aggregated", aggtype="kurtosis")),
    )


def _spectrum(s: Series, number: int) -> DataFrame:
    """Per id the first coefficients and the sums of k^j times the magnitude.

    A series that fits a task is one short transform; longer ones go through
    ``long_spectrum``.
    """
    key = s.keys[0]
    kind = s.cold.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, re array<double>, im array<double>, s array<double>"

    def transform(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        z = np.fft.rfft(rows.sort_values("pos")["flux"].to_numpy())
        k, size = np.arange(len(z), dtype=float), np.abs(z)
        sums = [float((k**j * size).sum()) for j in range(5)]
        return pd.DataFrame(
            {key: [group[0]], "re": [z.real[:number]], "im": [z.imag[:number]], "s": [sums]}
        )

    found = s.cold.select(key, "pos", "flux").groupBy(key).applyInPandas(transform, schema)
    return found if s.hot is None else found.unionByName(_long_spectrum_sums(s, number))


def _long_spectrum_sums(s: Series, number: int) -> DataFrame:
    key = s.keys[0]
    z = long_spectrum(s.hot.filter("_own"), key)
    k = F.col("k").cast("double")
    size = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))
    first = z.filter(F.col("k") < number).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("k", "re", "im"))).alias("c")
    )
    sums = z.groupBy(key).agg(F.array(*[F.sum(F.pow(k, F.lit(float(j))) * size) for j in range(5)]).alias("s"))
    return first.join(sums, key).select(
        key,
        F.transform("c", lambda c: c["re"]).alias("re"),
        F.transform("c", lambda c: c["im"]).alias("im"),
        "s",
    )


def long_spectrum(rows: DataFrame, key: str) -> DataFrame:
    """Fourier transform of series too long for one task: ``(key, k, re, im)``.

    A chirp turns the transform into a convolution of power-of-two length M,
    and each transform of length M is two rounds of about sqrt(M) short ones,
    grouped by residue and by low frequency (Bluestein; Bailey's four steps).
    """
    slots = max(1, -(-8 * rows.count() // LINE_ROWS))  # a series has up to 4 n values of two channels
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    power = F.ceil(F.log2(2 * F.col("n") - 1)).cast("int")
    sizes = sizes.withColumn("p", power).selectExpr(
        key, "n", "shiftleft(1L, p div 2) as m1", "shiftleft(1L, p - p div 2) as m2"
    )
    base = rows.select(key, F.col("pos").alias("t"), "flux").join(F.broadcast(sizes), key)

    def chirp(name: str) -> Column:
        return F.expr(f"pi() * ((cast({name} as decimal(38)) * {name}) % (2 * n)) / n").cast("double")

    a = base.withColumn("c", chirp("t")).selectExpr(
        key, "n", "m1", "m2", "0 as ch", "t", "flux * cos(c) as re", "-flux * sin(c) as im"
    )
    b = base.withColumn("c", chirp("t")).selectExpr(
        key, "n", "m1", "m2", "1 as ch",
        "explode(if(t = 0, array(t), array(t, m1 * m2 - t))) as t", "cos(c) as re", "sin(c) as im",
    )
    both = _four_steps(a.unionByName(b), key, slots)
    left = both.filter("ch = 0").selectExpr(key, "n", "m1", "m2", "t", "re as ar", "im as ai")
    right = both.filter("ch = 1").selectExpr(key, "t", "re as br", "im as bi")
    product = left.join(right, [key, "t"]).selectExpr(
        key, "n", "m1", "m2", "2 as ch", "t", "ar * br - ai * bi as re", "-(ar * bi + ai * br) as im"
    )
    back = _four_steps(product, key, slots).filter("t <= n div 2").withColumn("c", chirp("t"))
    back = back.selectExpr(key, "t as k", "c", "re / (m1 * m2) as re", "-im / (m1 * m2) as im")
    return back.selectExpr(key, "k", "re * cos(c) + im * sin(c) as re", "im * cos(c) - re * sin(c) as im")


def _four_steps(df: DataFrame, key: str, slots: int) -> DataFrame:
    """Transforms of length m1 * m2 per (key, ch); a task call holds about ``LINE_ROWS`` values.

    A call has some lines of one long transform, or the whole short transforms
    of the series in a slot, and does all lines of one length at once.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n long, m1 long, m2 long, ch int, a long, b long, re double, im double"
    fixed = [key, "n", "m1", "m2", "ch"]

    def lines(rows: pd.DataFrame, line: str, place: str, size: str) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
        """Per length a row for each line and their spectra."""
        for length, part in rows.groupby(size, sort=False):
            index = part.groupby([key, "ch", line], sort=False).ngroup().to_numpy()
            first = np.unique(index, return_index=True)[1]
            dense = np.zeros((len(first), length), dtype=complex)
            dense[index, part[place].to_numpy()] = part["re"].to_numpy() + 1j * part["im"].to_numpy()
            yield part.iloc[first][[*fixed, line]], np.fft.fft(dense, axis=1)

    def emit(heads: pd.DataFrame, place: str, values: np.ndarray) -> pd.DataFrame:
        """A row per line and frequency; ``place`` numbers the frequencies."""
        count, length = values.shape
        out = heads.iloc[np.repeat(np.arange(count), length)].reset_index(drop=True)
        out[place], out["re"], out["im"] = np.tile(np.arange(length), count), values.real.ravel(), values.imag.ravel()
        return out[[*fixed, "a", "b", "re", "im"]]

    def by_residue(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for heads, values in lines(rows, "b", "a", "m1"):
            whole = (heads["m1"] * heads["m2"]).to_numpy()[:, None]
            turns = (np.arange(values.shape[1])[None, :] * heads["b"].to_numpy()[:, None]) % whole
            out.append(emit(heads, "a", values * np.exp(-2j * np.pi * turns / whole)))
        return pd.concat(out)

    def by_low_frequency(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([emit(heads, "b", values) for heads, values in lines(rows, "a", "b", "m2")])

    def bundle(line: str, length: str) -> Column:
        some = f"xxhash64({key}, ch, {line} div greatest(1L, {LINE_ROWS}L div {length}))"
        return F.expr(f"if(m1 * m2 > {LINE_ROWS}L, {some}, pmod(xxhash64({key}), {slots}L))").alias("g")

    split = df.selectExpr(key, "n", "m1", "m2", "ch", "t div m2 as a", "t % m2 as b", "re", "im")
    once = split.groupBy(bundle("b", "m1")).applyInPandas(by_residue, schema)
    twice = once.groupBy(bundle("a", "m2")).applyInPandas(by_low_frequency, schema)
    return twice.selectExpr(key, "n", "m1", "m2", "ch", "a + m1 * b as t", "re", "im")


def welch(s: Series) -> DataFrame:
    """Welch power density bins and the entropy of the whole density.

    Each segment of 256 samples (half overlapping) is a group of its own.
    """
    s = s.with_stats(_n=F.count(F.lit(1)))
    rows = s.rows().select(*s.keys, "pos", "flux", "_n")
    half = SEGMENT // 2
    place = F.expr(f"pos div {half}")
    last = F.expr(f"(_n - {SEGMENT}) div {half}")
    candidates = F.array(place, place - 1)
    segments = F.when(
        F.col("_n") < SEGMENT, F.array(F.lit(0).cast("long"))
    ).otherwise(F.filter(candidates, lambda g: (g >= 0) & (g <= last)))
    pieces = rows.withColumn("_g", F.explode(segments)).groupBy(*s.keys, "_g").agg(
        F.array_sort(F.collect_list(F.struct("pos", "flux"))).alias("_p")
    )
    pieces = pieces.select(*s.keys, F.transform("_p", lambda p: p["flux"]).alias("_p"))

    @F.pandas_udf("array<double>")
    def density(parts: pd.Series) -> pd.Series:
        return parts.map(segment_density)

    @F.pandas_udf("array<double>")
    def entropies(spectra: pd.Series) -> pd.Series:
        return spectra.map(lambda v: [histogram_entropy(np.asarray(v), b) for b in ENTROPY_BINS])

    powers = pieces.select(*s.keys, F.posexplode(density("_p")).alias("_f", "_v"))
    mean = powers.groupBy(*s.keys, "_f").agg(F.avg("_v").alias("_v"))
    spectrum = mean.groupBy(*s.keys).agg(F.array_sort(F.collect_list(F.struct("_f", "_v"))).alias("_s"))
    spectrum = spectrum.select(*s.keys, F.transform("_s", lambda p: p["_v"]).alias("_s"))
    found = spectrum.withColumn("_e", entropies("_s"))
    return found.select(
        *s.keys,
        *[F.get("_s", F.lit(k)).alias(feature("spkt_welch_density", coeff=k)) for k in WELCH_BINS],
        *[F.get("_e", F.lit(i)).alias(feature("fourier_entropy", bins=b)) for i, b in enumerate(ENTROPY_BINS)],
    )


def segment_density(values: np.ndarray) -> np.ndarray:
    """One-sided power density of a segment, Hann window, mean removed, rate 1."""
    x = np.asarray(values, dtype=float)
    n = len(x)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n) if n > 1 else np.ones(1)
    power = np.abs(np.fft.rfft(window * (x - x.mean()))) ** 2 / max((window**2).sum(), 1e-300)
    stop = len(power) - 1 if n % 2 == 0 else len(power)
    power[1:stop] *= 2
    return power


def histogram_entropy(values: np.ndarray, bins: int) -> float:
    top = values.max()
    if not top > 0:
        return 0.0
    share = np.histogram(values / top, bins=bins)[0] / len(values)
    share = share[share > 0]
    return float(-(share * np.log(share)).sum())


def cwt_coefficients(s: Series) -> DataFrame:
    """The first wavelet coefficients; only the start of a series enters them."""
    s = s.with_stats(_n=F.count(F.lit(1)))
    reach = CWT_COEFFICIENTS + 5 * max(CWT_WIDTHS)
    heads = s.where(F.col("pos") < reach).per_key(
        F.max("_n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "flux"))).alias("p")
    )
    heads = heads.select(*s.keys, "n", F.transform("p", lambda p: p["flux"]).alias("x"))

    @F.pandas_udf("array<double>")
    def transform(sizes: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([_first_wavelets(int(n), np.asarray(x)) for n, x in zip(sizes, values)])

    found = heads.select(*s.keys, "n", transform("n", "x").alias("c"))
    return found.select(
        *s.keys,
        *[
            F.when(F.col("n") > i, F.get("c", F.lit(j * CWT_COEFFICIENTS + i))).alias(
                feature("cwt_coefficients", coeff=i, w=width, widths="2_5_10_20")
            )
            for j, width in enumerate(CWT_WIDTHS)
            for i in range(CWT_COEFFICIENTS)
        ],
    )


def _first_wavelets(n: int, head: np.ndarray) -> list[float]:
    out = []
    for width in CWT_WIDTHS:
        length = min(10 * width, n)
        place = np.arange(CWT_COEFFICIENTS)[:, None] + (length - 1) // 2 - np.arange(len(head))
        weight = np.where((place >= 0) & (place < length), _ricker_at(place - (length - 1) / 2, width), 0.0)
        out += (weight @ head).tolist()
    return out


def cwt_peaks(s: Series) -> DataFrame:
    """Ridges of the wavelet transform through all widths 1..n.

    A ridge is a chain of strict local maxima, one per width, moving by at
    most one position from width to width. Outside the series values are 0.
    """
    top = max(CWT_PEAK_WIDTHS)
    s = s.with_stats(_n=F.count(F.lit(1)))
    for width in range(1, top + 1):
        half = 5 * width
        offsets = range(-half, half)
        # a kernel of even length is centred between two samples
        weights = F.array(*[F.lit(float(_ricker_at(j + 0.5, width))) for j in offsets])
        s = s.windowed(lambda w, h=half: {"_frame": w.frame(F.collect_list("flux"), -h, h - 1)})
        missing = F.greatest(F.lit(half) - F.col("pos"), F.lit(0))
        part = F.slice(weights, (missing + 1).cast("int"), F.size("_frame"))
        value = F.aggregate(F.zip_with("_frame", part, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        s = s.with_columns(**{f"_c{width}": value}).drop("_frame")
        c = f"_c{width}"
        s = s.windowed(lambda w, c=c: {"_left": w.back(c), "_right": w.ahead(c)})
        inner = F.col("_left").isNotNull() & F.col("_right").isNotNull()
        maximum = inner & (F.col(c) > F.col("_left")) & (F.col(c) > F.col("_right"))
        s = s.with_columns(**{f"_m{width}": maximum}).drop("_left", "_right", c)
        if width > 1:
            below = f"_m{width - 1}"
            s = s.windowed(
                lambda w, b=below: {"_near": w.frame(F.max(F.col(b).cast("int")), -1, 1)}
            )
            s = s.with_columns(**{f"_m{width}": F.col(f"_m{width}") & (F.col("_near") == 1)}).drop("_near")
    return s.per_key(*[F.count_if(F.col(f"_m{n}")).alias(feature("number_cwt_peaks", n=n)) for n in CWT_PEAK_WIDTHS])


def _ricker_at(t, width: int):
    scale = 2 / (math.sqrt(3 * width) * math.pi**0.25)
    q = np.square(t) / (width * width)
    return scale * (1 - q) * np.exp(-q / 2)
