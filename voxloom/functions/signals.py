"""Measures, detectors and filters of audio signals.

Measures that need no transform are columns over arrays; the others are numpy kernels that run on
Arrow batches through :func:`measured` and :func:`filtered`. Signals are arrays of samples in -1..1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TINY = 1e-8

# Columns over arrays


def _sum(x: Column, f: Callable[[Column], Column]) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + f(v.cast("double")))


def rms(x: Column) -> Column:
    """Root mean square; null for an empty signal."""
    return F.sqrt(_sum(x, lambda v: v * v) / F.nullif(F.size(x), F.lit(0)))


def energy_db(x: Column) -> Column:
    """Level in dB, -100 for silence."""
    r = rms(x)
    return F.when(r < 1e-10, -100.0).otherwise(20 * F.log10(r))


def peak(x: Column) -> Column:
    return F.array_max(F.transform(x, lambda v: F.abs(v.cast("double"))))


def seconds(x: Column, rate: Column) -> Column:
    """Length in seconds; null without a rate over 0."""
    return F.size(x) / F.when(rate > 0, rate)


def is_sound(x: Column, rate: Column) -> Column:
    """Whether there is a signal at all: samples, a rate, and no NaN or infinite value."""
    bad = F.exists(x, lambda v: F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return F.coalesce((F.size(x) > 0) & (rate > 0) & ~bad, F.lit(False))


def zero_crossings(x: Column) -> Column:
    """Share of neighbouring samples of different sign."""
    n = F.size(x)
    pairs = F.zip_with(F.slice(x, 1, F.greatest(n - 1, F.lit(0))), F.slice(x, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: ((a >= 0) != (b >= 0)).cast("double"))
    return F.when(n > 1, _sum(pairs, lambda v: v) / (n - 1))


def snr_db(clean: Column, noisy: Column, cap: float = 40.0) -> Column:
    """Power of the clean signal over that of the difference, in dB, ``cap`` at most and without noise.

    Both are cut to the shorter length.
    """
    n = F.least(F.size(clean), F.size(noisy))
    a, b = F.slice(clean, 1, n), F.slice(noisy, 1, n)
    signal = _sum(a, lambda v: v * v)
    noise = _sum(F.zip_with(a, b, lambda p, q: p.cast("double") - q.cast("double")), lambda v: v * v)
    return F.when(n > 0, F.when(noise < 1e-20, float(cap)).otherwise(F.least(F.lit(float(cap)), 10 * F.log10(F.greatest(signal, F.lit(1e-20)) / noise))))


def si_sir_db(reference: Column, estimate: Column, mixture: Column) -> Column:
    """Part of the estimate along the reference against the part along the rest of the mixture, in dB."""
    d = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
    other = F.zip_with(mixture, reference, lambda m, r: m.cast("double") - r.cast("double"))
    along = lambda x: F.pow(d(estimate, x), 2) / F.nullif(d(x, x), F.lit(0.0))
    return 10 * F.log10(F.greatest(along(reference), F.lit(1e-12)) / F.greatest(along(other), F.lit(1e-12)))


# Kernels

Kernel = Callable[[np.ndarray, int], Mapping[str, float]]


def frames(x: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Whole frames of the signal as rows; a shorter signal is one frame filled up with zeros."""
    if len(x) < size:
        return np.pad(x, (0, size - len(x)))[None]
    return np.lib.stride_tricks.sliding_window_view(x, size)[::hop]


def spectrum(x: np.ndarray, size: int = 512, hop: int = 256) -> np.ndarray:
    """Power of every frame and frequency under a Hann window."""
    return np.abs(np.fft.rfft(frames(x, size, hop) * np.hanning(size), axis=1)) ** 2


def blind_snr(x: np.ndarray, rate: int) -> float:
    """SNR without a reference: speech frames against the quietest twentieth, -20 to 60 dB."""
    top = np.abs(x).max(initial=0.0)
    if not len(x) or top < 1e-10:
        return -20.0
    power = (frames(x / top, max(1, rate // 50), max(1, rate // 100)) ** 2).mean(1)
    noise = max(np.percentile(power, 5), 1e-10)
    loud = power[power > 2 * noise]
    signal = max((loud.mean() if len(loud) else power.mean()) - noise, 1e-10)
    return float(np.clip(10 * np.log10(signal / noise), -20, 60))


def percentile_snr(x: np.ndarray) -> float:
    """Loudest half of squared samples against the quietest tenth, in dB, 40 at most."""
    p = np.sort(x**2)
    low, high = p[: max(1, len(p) // 10)].mean(), p[len(p) // 2 :].mean()
    return 40.0 if low <= 0 else float(min(40.0, 10 * np.log10(max(high, 1e-20) / low)))


def frame_snr(x: np.ndarray, rate: int) -> float:
    """Mean energy of 20 ms frames against their tenth percentile, in dB; 0 without noise or without a frame that ends before the signal does."""
    size = int(0.02 * rate)
    power = (frames(x[:-1], size, max(1, size // 2)) ** 2).mean(1) if 0 < size < len(x) else np.zeros(1)
    noise = np.percentile(power, 10)
    return float(10 * np.log10(power.mean() / noise)) if noise > 0 else 0.0


def quick_snr(x: np.ndarray) -> float:
    """Ninetieth against tenth percentile of squared samples, in dB, 40 without noise."""
    high, low = np.percentile(x**2, [90, 10])
    return float(10 * np.log10(high / low)) if low > 0 else 40.0


def density(x: np.ndarray, rate: int, window: np.ndarray, hop: int) -> np.ndarray:
    """One-sided power spectral density of each whole frame, its mean removed."""
    f = frames(x, len(window), hop)
    p = np.abs(np.fft.rfft((f - f.mean(1, keepdims=True)) * window, axis=1)) ** 2 / (rate * (window**2).sum())
    p[:, 1 : None if len(window) % 2 else -1] *= 2
    return p


def welch(x: np.ndarray, rate: int, size: int) -> np.ndarray:
    """Mean density of half-overlapping Hann frames; a shorter signal is one frame."""
    size = min(size, len(x))
    window = np.hanning(size + 1)[:-1] if size > 1 else np.ones(1)
    return density(x, rate, window, max(1, size - size // 2)).mean(0)


def spectral_distortion(reference: np.ndarray, degraded: np.ndarray, rate: int, size: int = 512) -> float:
    """Root mean square ratio of Welch densities, in dB."""
    n = min(len(reference), len(degraded))
    a, b = (np.maximum(welch(x[:n], rate, size), 1e-10) for x in (reference, degraded))
    return float(np.sqrt(((10 * np.log10(b / a)) ** 2).mean()))


def spectral_peaks(s: np.ndarray, least: float = 0.1) -> set[int]:
    """Places of local peaks (the middle of flat ones) that stand out by a share of the largest value."""
    start = np.flatnonzero(np.r_[True, np.diff(s) != 0])
    end, v = np.r_[start[1:], len(s)] - 1, s[start]
    inner = np.flatnonzero((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])) + 1
    limit, out = least * s.max(initial=0.0), set()
    for k in inner[v[inner] - v.min(initial=0.0) >= limit]:
        before, after = np.flatnonzero(v[:k] > v[k]), np.flatnonzero(v[k + 1 :] > v[k])
        left = v[before[-1] + 1 if len(before) else 0 : k + 1].min()
        right = v[k : k + 1 + after[0] if len(after) else len(v)].min()
        if v[k] - max(left, right) >= limit:
            out.add(int(start[k] + end[k]) // 2)
    return out


def si_sar(reference: np.ndarray, separated: np.ndarray) -> float:
    """Part of the signal along the reference against the rest, in dB, less 5 for each share of clipped samples and of new spectral peaks."""
    n = min(len(reference), len(separated))
    r, s = (x[:n] - x[:n].mean() for x in (reference, separated))
    along = (s @ r) / (r @ r + TINY) * r
    a, b = (p / (p.max() + TINY) for p in (np.abs(np.fft.rfft(x)) for x in (r, s)))
    known = spectral_peaks(a)
    penalty = 5 * ((np.abs(s) > 0.95).mean() + len(spectral_peaks(b) - known) / (len(known) + 1))
    rest = ((s - along) ** 2).sum()
    if rest < TINY:
        return float(40 - penalty)
    return float(np.clip(10 * np.log10(max((along**2).sum(), 1e-300) / (rest + TINY)) - penalty, -20, 40))


def _voiced(x: np.ndarray, rate: int) -> list[tuple[float, float]]:
    """Segments of 100 ms and more whose frames (25 ms, each 10) rise over the noise floor, with hysteresis."""
    size, hop = int(0.025 * rate), int(0.01 * rate)
    if hop < 1 or len(x) <= size:
        return []
    level = np.sqrt((frames(x[:-1], size, hop) ** 2).mean(1))
    ordered = np.sort(level)
    floor, speech = ordered[: max(1, len(ordered) // 10)].mean(), ordered[len(ordered) // 2 :].mean()
    limit = 2.5 * floor if speech > 3 * floor else np.percentile(level, 30)
    # Between the bounds a frame is as the one before it.
    state = np.where(level > 1.2 * limit, 1, np.where(level > 0.8 * limit, -1, 0))
    last = np.maximum.accumulate(np.where(state >= 0, np.arange(len(state)), -1))
    flags = (last >= 0) & (state[np.maximum(last, 0)] == 1)
    return [(a * hop / rate, min(len(x) / rate, b * hop / rate)) for a, b in runs(flags) if (b - a) * hop / rate * 1000 >= 100 - 1e-9]


def _time_snr(x: np.ndarray, rate: int, voiced: list[tuple[float, float]]) -> float:
    """Power of voiced samples against the median of the others; by percentiles if nothing is voiced."""
    if voiced:
        inside = np.zeros(len(x), bool)
        for a, b in voiced:
            inside[int(a * rate) : int(b * rate)] = True
        signal, quiet = (x[inside] ** 2).mean(), x[~inside] ** 2
        if len(quiet) > 100:
            quiet = quiet[quiet > 1e-10]
            noise = np.median(quiet) if len(quiet) else 1e-10
        else:
            p = np.sort(x**2)
            noise = p[max(1, int(len(p) * 0.05)) : int(len(p) * 0.15)].mean() if int(len(p) * 0.15) > max(1, int(len(p) * 0.05)) else 1e-10
    else:
        x = x - x.mean()
        top, level = np.abs(x).max(), np.sqrt((x**2).mean())
        if top < 1e-4 or (level < 1e-3 and top / level < 4):
            return 0.0
        p = np.sort(x**2)
        p = p[p > 1e-10]
        if len(p) < 100:
            return float(20 * np.log10(max(level / 0.001, 1)))
        noise, signal = max(np.median(p[int(len(p) * 0.05) : int(len(p) * 0.25)]), 1e-10), np.median(p[int(len(p) * 0.6) : int(len(p) * 0.95)])
        if signal / noise > 10000:
            flat = density(x, 16000, np.ones(len(x)), len(x))[0]
            noise = np.median(flat[len(flat) * 3 // 4 :]) * 2
    noise = max(noise, 1e-10)
    return float(10 * np.log10(max(signal, noise) / noise))


def _spectral_snr(x: np.ndarray, rate: int, voiced: list[tuple[float, float]]) -> float:
    """Voiced frames against the fifth percentile of each frequency from 300 to 3,400 Hz."""
    size, hop = min(int(0.025 * rate), len(x)), max(1, int(0.01 * rate))
    t = np.arange(size) / max(1, size) * 8  # Tukey's window, a quarter of it tapered
    window = np.where(t < 1, 0.5 - 0.5 * np.cos(np.pi * t), np.where(t > 7, 0.5 - 0.5 * np.cos(np.pi * (8 - t)), 1.0))
    p = density(x, rate, window, hop) ** 2
    chosen = np.zeros(len(p), bool)
    for a, b in voiced:
        chosen[int(a * rate / hop) : int(b * rate / hop)] = True
    if not voiced:
        energy = p.sum(1)
        chosen = energy > np.median(energy)
    signal = p[chosen].mean(0) if chosen.any() else p.mean(0)
    f = np.fft.rfftfreq(size, 1 / rate)
    band = (f >= 300) & (f <= 3400)
    top, low = signal[band].sum(), np.percentile(p, 5, axis=0)[band].sum()
    return 60.0 if low <= 0 else float(10 * np.log10(max(top, 1e-300) / low))


def enhanced_snr(x: np.ndarray, rate: int) -> tuple[float, float]:
    """SNR without a reference and its confidence: estimates over time and over the spectrum, blended by how much is voiced; pure tones by their band."""
    top = np.abs(x).max(initial=0.0)
    if not len(x):
        return -np.inf, 0.0
    x = x / top if top > 0 else x
    if top == 0:
        return 0.0, 0.3
    p = np.abs(np.fft.rfft(x)) ** 2
    k = int(p.argmax())
    if p[k] / (p.sum() + 1e-10) > 0.5 or (0 < k and 2 * k < len(p) and (p[k] + p[2 * k]) / p.sum() > 0.7):
        flat = welch(x, rate, 4096)
        f = np.fft.rfftfreq(min(len(x), 4096), 1 / rate)
        band = np.abs(f - f[flat.argmax()]) <= 50
        step = f[1] - f[0] if len(f) > 1 else 1.0
        return float(np.clip(10 * np.log10(max(flat[band].sum() * step, 1e-300) / max(flat[~band].sum() * step, 1e-10)), -20, 60)), 0.95
    voiced = _voiced(np.r_[x[:1], x[1:] - 0.97 * x[:-1]], rate)
    share = sum(b - a for a, b in voiced) * rate / len(x)
    weight, confidence = (0.3, 0.6) if not voiced else (0.7, 0.9) if 0.1 < share < 0.9 else (0.5, 0.7)
    return float(np.clip(weight * _time_snr(x, rate, voiced) + (1 - weight) * _spectral_snr(x, rate, voiced), -20, 60)), confidence


def spectral_shape(x: np.ndarray, rate: int) -> dict[str, float]:
    """Centroid, bandwidth, roll-off, flatness, flux and share of high frequencies."""
    p = spectrum(x)
    f = np.fft.rfftfreq(2 * (p.shape[1] - 1), 1 / rate)
    mean = p.mean(0) + 1e-20
    share = mean / mean.sum()
    centre = float((f * share).sum())
    unit = p / np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-20)
    return {
        "centroid": centre,
        "bandwidth": float(np.sqrt((((f - centre) ** 2) * share).sum())),
        "rolloff": float(f[min(np.searchsorted(np.cumsum(share), 0.85), len(f) - 1)]),
        "flatness": float(np.exp(np.log(mean).mean()) / mean.mean()),
        "flux": float(np.linalg.norm(np.diff(unit, axis=0), axis=1).mean()) if len(p) > 1 else 0.0,
        "high_share": float(share[f >= 4000].sum()),
    }


def mel_bank(rate: int, size: int, n: int = 40) -> np.ndarray:
    """Triangular filters, evenly spaced on the mel scale."""
    mel = lambda h: 2595 * np.log10(1 + h / 700)
    edges = 700 * (10 ** (np.linspace(0, mel(rate / 2), n + 2) / 2595) - 1)
    f = np.fft.rfftfreq(size, 1 / rate)
    up, down = (f - edges[:-2, None]) / np.diff(edges)[:-1, None], (edges[2:, None] - f) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(up, down))


def cepstra(x: np.ndarray, rate: int, n: int = 13) -> np.ndarray:
    """Mel-frequency cepstral coefficients of every frame."""
    p = np.abs(np.fft.rfft(frames(x, 512, 256) * np.hamming(512), axis=1)) ** 2
    logs = np.log(p @ mel_bank(rate, 512).T + 1e-10)
    k = np.arange(n)[:, None] * (np.arange(logs.shape[1]) + 0.5) * np.pi / logs.shape[1]
    return logs @ np.cos(k).T


def cepstrum(x: np.ndarray, rate: int, n: int = 13) -> np.ndarray:
    """Mean mel-frequency cepstral coefficients."""
    return cepstra(x, rate, n).mean(0)


def voice_similarity(a: np.ndarray, b: np.ndarray, rate: int) -> float:
    """Cosine of mean cepstra, scaled to 0..1."""
    x, y = cepstrum(a, rate), cepstrum(b, rate)
    return float((x @ y / max(np.linalg.norm(x) * np.linalg.norm(y), 1e-12) + 1) / 2)


def log_spectral_distance(a: np.ndarray, b: np.ndarray) -> float:
    """Root mean square difference of log spectra, in dB."""
    n = min(len(a), len(b))
    x, y = (10 * np.log10(np.abs(np.fft.rfft(s[:n])) ** 2 + 1e-10) for s in (a, b))
    return float(np.sqrt(((x - y) ** 2).mean()))


def spectral_divergence(a: np.ndarray, b: np.ndarray) -> float:
    """Mean Kullback-Leibler divergence of the frames' spectra."""
    n = min(len(a), len(b))
    x, y = (s / s.sum(1, keepdims=True) for s in (spectrum(a[:n]) + 1e-10, spectrum(b[:n]) + 1e-10))
    return float((x * np.log(x / y)).sum(1).mean())


def band_preservation(original: np.ndarray, processed: np.ndarray, rate: int, cutoff: float = 4000.0) -> float:
    """Energy at and over the cutoff after against before; 1 where there was none."""
    high = lambda x: (np.abs(np.fft.rfft(x)) ** 2)[np.fft.rfftfreq(len(x), 1 / rate) >= cutoff].sum()
    before = high(original)
    return float(high(processed) / before) if before > 1e-12 else 1.0


def noise_kind(x: np.ndarray, rate: int) -> str:
    """white, pink, brown or colored by the slope of the spectrum; periodic or non-stationary before that."""
    p = spectrum(x)
    power = p.sum(1)
    mean = p.mean(0)[1:] + 1e-20
    auto = np.correlate(mean - mean.mean(), mean - mean.mean(), "full")[len(mean) - 1 :]
    if mean.max() / mean.sum() > 0.5 or (len(auto) > 8 and auto[4:].max() / max(auto[0], 1e-20) > 0.7):
        return "periodic"
    if len(power) > 3 and power.mean() > 0 and 1 - power.std() / power.mean() < 0.5:
        return "non_stationary"
    f = np.fft.rfftfreq(2 * p.shape[1] - 2, 1 / rate)[1:]
    slope = np.polyfit(np.log10(f), np.log10(mean), 1)[0]
    return "white" if abs(slope) <= 0.5 else "brown" if slope <= -1.5 else "pink" if slope < -0.5 else "colored"


def energy_vad(x: np.ndarray, rate: int, aggressiveness: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Speech flag and probability of every 20 ms frame, against the mean of the quietest tenth."""
    size = max(1, rate // 50)
    power = (frames(x, size, size) ** 2).mean(1)
    floor = np.sort(power)[: max(1, len(power) // 10)].mean()
    limit = max(floor * (1.5, 2.0, 2.5, 3.0)[aggressiveness], 1e-10)
    ratio = power / limit
    return ratio > 1, 1 / (1 + np.exp(-np.clip(5 * (ratio - 1), -50, 50)))


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values, as first place and place after the last."""
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def speech_segments(flags: np.ndarray, step: float, length: float, silence: float = 0.1, least: float = 0.1, pad: float = 0.05) -> list[tuple[float, float]]:
    """Flags of frames as padded segments; pauses under ``silence`` are bridged, segments under ``least`` dropped."""
    out: list[list[float]] = []
    for a, b in runs(flags):
        if out and a * step - out[-1][1] < silence - 1e-9:
            out[-1][1] = b * step
        else:
            out.append([a * step, b * step])
    return [(max(0.0, a - pad), min(length, b + pad)) for a, b in out if b - a >= least - 1e-9]


def clipped_runs(x: np.ndarray, level: float = 0.99, least: int = 4) -> list[tuple[int, int]]:
    """Runs of samples at full scale."""
    return [(a, b) for a, b in runs(np.abs(x) > level) if b - a >= least]


def dropouts(x: np.ndarray, rate: int, share: float = 0.01, least: int = 2) -> list[tuple[int, int]]:
    """Runs of 5 ms windows whose energy is under a share of the mean, between sounding ones; in windows."""
    size = max(1, rate // 200)
    power = (frames(x, size, size) ** 2).mean(1)
    low = power < share * power.mean()
    return [(a, b) for a, b in runs(low) if b - a >= least and a > 0 and b < len(low)]


def clicks(x: np.ndarray, rate: int, deviations: float = 5.0, longest_ms: int = 10) -> list[tuple[int, int, str]]:
    """Spikes of the energy difference of 1 ms windows as (first, after, kind), in windows: clicks, or pops if longer."""
    size = max(1, rate // 1000)
    change = np.abs(np.diff((frames(x, size, size) ** 2).mean(1)))
    if not len(change) or change.std() == 0:
        return []
    hit = change > change.mean() + deviations * change.std()
    out: list[list[int]] = []
    for a, b in runs(hit):
        if out and a - out[-1][1] <= 5:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b, "click" if b - a < longest_ms else "pop") for a, b in out if b - a < 50]


def interruptions(x: np.ndarray, rate: int, least: float = 0.8, gap: float = 0.2) -> list[tuple[float, float, float]]:
    """Stretches that sound like someone cutting in: frames scored by energy, zero crossings, centroid and jumps of pitch."""
    size, hop = max(64, rate // 20), max(32, rate // 40)
    f = frames(x, size, hop)
    # Factors, percentiles and weights of the four signs of an interruption, which results must agree on.
    energy = (f**2).mean(1)
    crossing = (np.diff(np.signbit(f), axis=1) != 0).mean(1)
    p = np.abs(np.fft.rfft(f, axis=1))
    freq = np.fft.rfftfreq(size, 1 / rate)
    centre = (p * freq).sum(1) / np.maximum(p.sum(1), 1e-12)
    pitch = freq[p[:, 1:].argmax(1) + 1]
    score = 0.3 * (energy > 2 * np.percentile(energy, 75)) + 0.2 * (crossing > 1.5 * np.percentile(crossing, 80)) + 0.2 * (centre > 1.8 * np.percentile(centre, 70))
    score = score + 0.3 * (np.abs(np.diff(pitch, prepend=pitch[:1])) > 50)
    out: list[list[float]] = []
    for k in np.flatnonzero(score >= least - 1e-9):
        a, b = k * hop / rate, (k * hop + size) / rate
        if out and a - out[-1][1] < gap:
            out[-1][1], out[-1][2] = max(out[-1][1], b), max(out[-1][2], float(score[k]))
        else:
            out.append([a, b, float(score[k])])
    return [tuple(r) for r in out]


# Filters, signal to signal


def suppressed(x: np.ndarray, rate: int, stretches: list[tuple[float, float]], pad: float = 0.05, factor: float = 0.15) -> np.ndarray:
    """The signal with padded stretches turned down; where two meet, twice."""
    out = x.copy()
    for a, b in stretches:
        out[max(0, int((a - pad) * rate)) : max(0, int((b + pad) * rate))] *= factor
    return out


def normalised(x: np.ndarray, level_db: float = -20.0, method: str = "rms", ceiling: float = 0.99) -> np.ndarray:
    """The signal at a level by its rms or peak, turned down as a whole if it would clip; silence stays."""
    size = np.sqrt((x**2).mean()) if method == "rms" else np.abs(x).max(initial=0.0)
    if not len(x) or size < 1e-10:
        return x
    out = x * (10 ** (level_db / 20) / size)
    return out * min(1.0, ceiling / max(np.abs(out).max(), 1e-12))


def resampled(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """The signal at another rate: frequencies over the new limit are removed in the spectrum."""
    if rate == to or not len(x):
        return x
    n = round(len(x) * to / rate)
    s = np.fft.rfft(x)[: n // 2 + 1]
    return np.fft.irfft(s, n) * (n / len(x))


def trimmed(x: np.ndarray, rate: int, under_db: float = 30.0) -> np.ndarray:
    """Without the ends that are so far under the loudest frame."""
    size = max(1, rate // 50)
    level = np.sqrt((frames(x, size, size) ** 2).mean(1))
    loud = np.flatnonzero(level > level.max(initial=0.0) * 10 ** (-under_db / 20))
    return x[loud[0] * size : (loud[-1] + 1) * size + size] if len(loud) else x


def _gained(x: np.ndarray, gain: Callable[[np.ndarray], np.ndarray], size: int = 512) -> np.ndarray:
    """Overlap-add of frames whose spectra are weighted by ``gain`` of their power."""
    if len(x) < size:
        return x.copy()
    hop, window = size // 2, np.hanning(size + 1)[:-1]
    padded = np.pad(x, (hop, size))
    f = np.lib.stride_tricks.sliding_window_view(padded, size)[::hop]
    s = np.fft.rfft(f * window, axis=1)
    parts = np.fft.irfft(s * gain(np.abs(s) ** 2), size, axis=1)
    out = np.zeros((len(parts) + 1) * hop)
    for half in (0, 1):
        part = parts[:, half * hop : (half + 1) * hop].ravel()
        out[half * hop : half * hop + len(part)] += part
    return out[hop : hop + len(x)]


def _noise_floor(p: np.ndarray) -> np.ndarray:
    """Mean noise power of each frequency: noise power is exponential, so its tenth percentile is -ln(0.9) of the mean."""
    return np.percentile(p, 10, axis=0) / -np.log(0.9) + 1e-12


def gated(x: np.ndarray, factor: float = 2.0, floor: float = 0.1) -> np.ndarray:
    """Spectral gate: what is under a multiple of each frequency's noise floor is turned down."""
    return _gained(x, lambda p: np.where(p > factor * _noise_floor(p), 1.0, floor))


def wiener(x: np.ndarray, smoothing: float = 0.98, floor: float = 0.1) -> np.ndarray:
    """Decision-directed Wiener filter over each frequency's noise floor."""

    def gain(p: np.ndarray) -> np.ndarray:
        noise = _noise_floor(p)
        out, clean = np.empty_like(p), np.zeros(p.shape[1])
        for i, row in enumerate(p):
            prior = smoothing * clean / noise + (1 - smoothing) * np.maximum(row / noise - 1, 0)
            out[i] = np.maximum(prior / (1 + prior), floor)
            clean = out[i] ** 2 * row
        return out

    return _gained(x, gain)


def subtracted(x: np.ndarray, over: float = 1.5, floor: float = 0.1) -> np.ndarray:
    """Spectral subtraction with gains smoothed over time."""

    def gain(p: np.ndarray) -> np.ndarray:
        g = np.sqrt(np.maximum(1 - over * _noise_floor(p) / np.maximum(p, 1e-12), floor**2))
        return (g + np.vstack([g[:1], g[:-1]])) / 2

    return _gained(x, gain)


def standardised(x: np.ndarray, rate: int, to: int = 16000, level_db: float = -20.0) -> np.ndarray:
    """One rate, no silent ends, one level."""
    return np.clip(normalised(trimmed(resampled(x, rate, to), to), level_db), -1, 1)


def pair_sums(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, ...]:
    """For two list columns of equal lengths row by row: size, and sums of a, b, aa, bb, ab and (a - b)²."""
    size = a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    x, y = (c.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for c in (a, b))
    row = np.repeat(np.arange(len(size)), size)
    total = lambda v: np.bincount(row, v, minlength=len(size))
    return size, total(x), total(y), total(x * x), total(y * y), total(x * y), total((x - y) ** 2)


def with_levels(df: DataFrame, array: str) -> DataFrame:
    """Add ``rms``, ``db`` (-100 for silence) and ``peak`` of each signal, null where it is null or empty. The signal is dropped."""
    kept = [f for f in df.schema.fields if f.name not in (array, "rms", "db", "peak")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, _, _, power, _, _, _ = pair_sums(batch.column(array), batch.column(array))
            x = np.abs(batch.column(array).flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            some = size > 0
            top = np.zeros(len(size))
            top[some] = np.maximum.reduceat(x, (np.cumsum(size) - size)[some]) if len(x) else 0
            rms_ = np.sqrt(power / np.maximum(size, 1))
            db = np.where(rms_ < 1e-10, -100.0, 20 * np.log10(np.maximum(rms_, 1e-300)))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *(pa.array(v, mask=~some) for v in (rms_, db, top))], [*(f.name for f in kept), "rms", "db", "peak"])

    return df.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "rms double, db double, peak double"]))


def with_ratios(df: DataFrame, reference: str, estimate: str, cap: float = 40.0, low: float = -20.0, high: float = 100.0) -> DataFrame:
    """Add ``snr`` (``cap`` at most and without noise) and the scale-invariant ``si_sdr`` (between ``low`` and ``high``), in dB.

    Null where a signal is null or empty, lengths differ or, for ``si_sdr``, the reference has no energy. Both signals are dropped.
    """
    kept = [f for f in df.schema.fields if f.name not in (reference, estimate, "snr", "si_sdr")]
    good = (F.size(reference) == F.size(estimate)) & (F.size(reference) > 0)
    rows = df.withColumns({reference: F.when(good, F.col(reference)), estimate: F.when(good, F.col(estimate))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sa, sb, aa, bb, ab, dd = pair_sums(batch.column(reference), batch.column(estimate))
            size = np.maximum(n, 1)
            power, cross = aa - sa * sa / size, ab - sa * sb / size
            with np.errstate(all="ignore"):
                snr = np.where(dd < 1e-20, cap, np.minimum(cap, 10 * np.log10(np.maximum(aa, 1e-20) / dd)))
                scale = cross / power
                target = scale * scale * power
                noise = bb - sb * sb / size - 2 * scale * cross + target
                sdr = np.where(noise < 1e-20, high, np.clip(10 * np.log10(np.maximum(target, 1e-20) / noise), low, high))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(snr, mask=n == 0), pa.array(sdr, mask=(n == 0) | (power <= 1e-20))], [*(f.name for f in kept), "snr", "si_sdr"]
            )

    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "snr double, si_sdr double"]))


# Kernels on frames of data


def features(x: np.ndarray, rate: int) -> dict[str, float]:
    """The measures that tell kinds of recordings apart."""
    flags, _ = energy_vad(x, rate)
    enhanced, confidence = enhanced_snr(x, rate)
    snrs = {"snr": blind_snr(x, rate), "percentile_snr": percentile_snr(x), "enhanced_snr": enhanced, "enhanced_confidence": confidence, "frame_snr": frame_snr(x, rate), "quick_snr": quick_snr(x)}
    return {**snrs, "speech_share": float(flags.mean()), "n_clipped": float(len(clipped_runs(x))), "n_dropouts": float(len(dropouts(x, rate))), "n_clicks": float(len(clicks(x, rate))), **spectral_shape(x, rate)}


def _signals(batch: pa.RecordBatch, array: str, rate: str) -> Iterator[tuple[np.ndarray, int] | None]:
    for x, r in zip(batch.column(array), batch.column(rate).to_pylist(), strict=True):
        v = x.values.to_numpy(zero_copy_only=False).astype(np.float64) if x.is_valid else np.zeros(0)
        yield (v, r) if len(v) and r and r > 0 and np.isfinite(v).all() else None


def measured(df: DataFrame, array: str, rate: str, kernel: Kernel = features, output: str = "measures") -> DataFrame:
    """Add a map of measures of each signal; null where there is no usable signal. The array is dropped."""
    kept = [f for f in df.schema.fields if f.name not in (array, rate, output)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [None if s is None else list(kernel(*s).items()) for s in _signals(batch, array, rate)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(values, pa.map_(pa.string(), pa.float64()))], [*(f.name for f in kept), output])

    return df.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{output}` map<string,double>"]))


def filtered(df: DataFrame, array: str, rate: str, kernel: Callable[[np.ndarray, int], np.ndarray]) -> DataFrame:
    """Each signal through a filter, with ``status``: ``done``, or why the signal is passed on unchanged (``unusable`` or the filter's error)."""
    df = df.drop("status")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, status = [], []
            for old, s in zip(batch.column(array).to_pylist(), _signals(batch, array, rate), strict=True):
                try:
                    out.append(old if s is None else kernel(*s).tolist())
                    status.append("unusable" if s is None else "done")
                except (ValueError, FloatingPointError, IndexError, np.linalg.LinAlgError) as e:
                    out.append(old)
                    status.append(f"{type(e).__name__}: {e}")
            columns = [pa.array(out, batch.schema.field(n).type) if n == array else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(status, pa.string())], [*batch.schema.names, "status"])

    return df.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), "status string"]))
