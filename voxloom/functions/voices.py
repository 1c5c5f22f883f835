"""Measures, detectors and filters that look at a whole signal: intelligibility, loudness, voices and what disturbs them.

All are numpy kernels for :func:`voxloom.functions.signals.measured` and ``filtered``; none needs a trained model. Where the usual
operator is a neural network, the kernel here is the arithmetic alternative and says so.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import permutations

import numpy as np

from voxloom.functions import signals as S

# Measures


def si_sdr(reference: np.ndarray, estimate: np.ndarray, low: float = -20.0, high: float = 100.0) -> float:
    """Scale-invariant signal-to-distortion ratio in dB, of the shorter length; NaN without energy in the reference."""
    n = min(len(reference), len(estimate))
    r, e = (x[:n] - x[:n].mean() if n else x[:0] for x in (reference, estimate))
    power = float(r @ r)
    if power <= 1e-20:
        return float("nan")
    target = (r @ e) / power * r
    noise = float(((e - target) ** 2).sum())
    return high if noise < 1e-20 else float(np.clip(10 * np.log10(max(float(target @ target), 1e-20) / noise), low, high))


def si_sdr_gain(mixture: np.ndarray, estimate: np.ndarray, reference: np.ndarray) -> float:
    """How much nearer the estimate is to the reference than the mixture was, in dB."""
    return si_sdr(reference, estimate) - si_sdr(reference, mixture)


def best_assignment(references: Sequence[np.ndarray], estimates: Sequence[np.ndarray]) -> tuple[float, list[int]]:
    """Mean ratio under the best assignment of estimates to references, and the estimate of each reference.

    All assignments are tried up to five sources; beyond, pairs are taken best first.
    """
    value = np.array([[si_sdr(r, e) for e in estimates] for r in references])
    n = len(references)
    if n <= 5:
        chosen = max(permutations(range(len(estimates)), n), key=lambda p: (sum(value[i, j] for i, j in enumerate(p)), [-j for j in p]))
    else:
        left, chosen = value.copy(), [0] * n
        for _ in range(n):
            i, j = np.unravel_index(np.nanargmax(left), left.shape)
            chosen[i] = int(j)
            left[i, :], left[:, j] = -np.inf, -np.inf
    return float(np.mean([value[i, j] for i, j in enumerate(chosen)])), [int(j) for j in chosen]


# ITU-R BS.1770's shelf and high pass as frequency, gain in dB and quality, and its gates in dB.
SHELF, HIGH_PASS = (1681.974450955533, 3.999843853973347, 0.7071752369554196), (38.13547087602444, 0.5003270373238773)
ABSOLUTE_GATE, RELATIVE_GATE, OFFSET = -70.0, -10.0, -0.691


def _k_weighted(x: np.ndarray, rate: int) -> np.ndarray:
    """The signal after both filters, applied in the spectrum of the padded signal."""
    n = 2 * len(x)
    z = np.exp(-2j * np.pi * np.fft.rfftfreq(n))
    f, gain, q = SHELF
    k, vh = np.tan(np.pi * f / rate), 10 ** (gain / 20)
    vb = vh**0.4996667741545416
    shelf = ((vh + vb * k / q + k * k) + 2 * (k * k - vh) * z + (vh - vb * k / q + k * k) * z * z) / ((1 + k / q + k * k) + 2 * (k * k - 1) * z + (1 - k / q + k * k) * z * z)
    f, q = HIGH_PASS
    k = np.tan(np.pi * f / rate)
    high = (1 - 2 * z + z * z) / (1 + 2 * (k * k - 1) / (1 + k / q + k * k) * z + (1 - k / q + k * k) / (1 + k / q + k * k) * z * z)
    return np.fft.irfft(np.fft.rfft(x, n) * shelf * high, n)[: len(x)]


def loudness(x: np.ndarray, rate: int) -> float:
    """Integrated loudness in LUFS by BS.1770: blocks of 0.4 s every 0.1 s, gated; -70 for silence. A shorter signal is one block."""
    size = int(0.4 * rate)
    power = (S.frames(_k_weighted(x, rate), min(size, max(len(x), 1)), max(1, rate // 10)) ** 2).mean(1)
    level = OFFSET + 10 * np.log10(np.maximum(power, 1e-20))
    loud = power[level > ABSOLUTE_GATE]
    if not len(loud):
        return ABSOLUTE_GATE
    gate = OFFSET + 10 * np.log10(loud.mean()) + RELATIVE_GATE
    kept = power[(level > ABSOLUTE_GATE) & (level > gate)]
    return float(OFFSET + 10 * np.log10(kept.mean()))


def at_loudness(x: np.ndarray, rate: int, target: float = -23.0, ceiling: float = 0.99) -> np.ndarray:
    """The signal at a loudness, turned down as a whole if it would clip; silence stays."""
    now = loudness(x, rate)
    if now <= ABSOLUTE_GATE:
        return x
    out = x * 10 ** ((target - now) / 20)
    return out * min(1.0, ceiling / max(np.abs(out).max(), 1e-12))


def intelligibility(clean: np.ndarray, processed: np.ndarray, rate: int) -> float:
    """Short-time objective intelligibility (Taal et al., 2011): mean correlation of third-octave envelopes over 384 ms.

    Signals under 150 ms, or with too few sounding frames, give the correlation of their samples, 0 at least.
    """
    n = min(len(clean), len(processed))
    a, b = (S.resampled(x[:n], rate, 10_000) for x in (clean, processed))
    plain = lambda: float(max(0.0, np.nan_to_num(np.corrcoef(a, b)[0, 1]))) if len(a) > 1 and a.std() > 0 and b.std() > 0 else 0.0
    if len(a) < 1500:
        return plain()
    window = np.hanning(258)[1:-1]
    fa, fb = S.frames(a, 256, 128) * window, S.frames(b, 256, 128) * window
    level = 20 * np.log10(np.linalg.norm(fa, axis=1) + 1e-12)
    sounding = level > level.max() - 40
    pa_, pb = (np.abs(np.fft.rfft(f[sounding], 512, axis=1)) ** 2 for f in (fa, fb))
    if len(pa_) < 30:
        return plain()
    freq = np.fft.rfftfreq(512, 1e-4)
    centre = 150 * 2.0 ** (np.arange(15) / 3)
    bank = np.array([(freq >= c * 2 ** (-1 / 6)) & (freq < c * 2 ** (1 / 6)) for c in centre], float)
    x, y = np.sqrt(pa_ @ bank.T), np.sqrt(pb @ bank.T)
    xs, ys = (np.lib.stride_tricks.sliding_window_view(v, 30, axis=0) for v in (x, y))
    scale = np.linalg.norm(xs, axis=2, keepdims=True) / (np.linalg.norm(ys, axis=2, keepdims=True) + 1e-12)
    ys = np.minimum(ys * scale, xs * (1 + 10 ** (15 / 20)))
    xs, ys = xs - xs.mean(2, keepdims=True), ys - ys.mean(2, keepdims=True)
    return float(((xs * ys).sum(2) / (np.linalg.norm(xs, axis=2) * np.linalg.norm(ys, axis=2) + 1e-12)).mean())


def _periods(f: np.ndarray, rate: int, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Frequency of each frame by autocorrelation, the highest whose peak is nearly the best, and how periodic it is, 0 to 1."""
    size = f.shape[1]
    window = np.hanning(size)
    f = (f - f.mean(1, keepdims=True)) * window
    auto = np.fft.irfft(np.abs(np.fft.rfft(f, 2 * size, axis=1)) ** 2, axis=1)[:, :size]
    own = np.fft.irfft(np.abs(np.fft.rfft(window, 2 * size)) ** 2)[:size]
    auto = auto / np.maximum(auto[:, :1], 1e-12) * (own[0] / np.maximum(own, 0.1 * own[0]))
    a, b = max(2, int(rate / high)), min(size - 2, int(rate / low))
    if b <= a:
        return np.full(len(f), low), np.zeros(len(f))
    here = auto[:, a : b + 1]
    peak = (here >= auto[:, a - 1 : b]) & (here >= auto[:, a + 1 : b + 2])
    best = np.where(peak, here, 0).max(1)
    lag = (peak & (here >= 0.9 * best[:, None])).argmax(1) + a
    best = np.clip(auto[np.arange(len(f)), lag], 0.0, 1.0)
    best[(f**2).mean(1) < 1e-10] = 0.0
    return rate / lag, best


def pitch(x: np.ndarray, rate: int, low: float = 60.0, high: float = 400.0) -> tuple[np.ndarray, np.ndarray]:
    """Fundamental of every 40 ms frame, 10 ms apart (0 if there is none), and how periodic the frame is, 0 to 1."""
    f0, best = _periods(S.frames(x, max(8, int(0.04 * rate)), max(1, rate // 100)), rate, low, high)
    return np.where(best > 0.5, f0, 0.0), best


def harmonicity(x: np.ndarray, rate: int) -> dict[str, float]:
    """Harmonics-to-noise ratio in dB, mean and spread of the fundamental, and its mean change from frame to frame (jitter)."""
    f0, sure = pitch(x, rate)
    on = f0 > 0
    r = np.clip(sure[on].mean() if on.any() else 0.0, 1e-3, 1 - 1e-3)
    period = 1 / f0[on] if on.any() else np.zeros(0)
    jitter = float(np.abs(np.diff(period)).mean() / period.mean()) if len(period) > 1 else 0.0
    return {"hnr_db": float(10 * np.log10(r / (1 - r))), "f0_mean": float(f0[on].mean()) if on.any() else 0.0, "f0_std": float(f0[on].std()) if on.any() else 0.0, "voiced_share": float(on.mean()), "jitter": jitter}


def formants(x: np.ndarray, rate: int, n: int = 4) -> list[float]:
    """The lowest resonances of the vocal tract, from the poles of linear prediction over the whole signal."""
    order = 2 + rate // 1000
    y = np.append(x[:1], x[1:] - 0.97 * x[:-1]) * np.hamming(len(x)) if len(x) else x
    if len(y) <= order or not np.any(y):
        return []
    auto = np.fft.irfft(np.abs(np.fft.rfft(y, 2 * len(y))) ** 2)[: order + 1]
    auto[0] *= 1 + 1e-9
    matrix = auto[np.abs(np.arange(order)[:, None] - np.arange(order)[None])]
    poles = np.roots(np.r_[1.0, -np.linalg.solve(matrix, auto[1:])])
    poles = poles[poles.imag > 0]
    freq, width = np.angle(poles) * rate / (2 * np.pi), -np.log(np.maximum(np.abs(poles), 1e-12)) * rate / np.pi
    return sorted(float(f) for f, w in zip(freq, width, strict=True) if f > 90 and w < 400)[:n]


def spectral_anomalies(x: np.ndarray, rate: int) -> dict[str, float]:
    """Holes (bins far under their neighbours), distortion (energy of harmonics over the loudest tone's), aliasing (share of energy in the top
    twentieth) and the frequency that a codec cut at (half the rate if none did)."""
    mean = S.spectrum(x).mean(0) + 1e-20
    db = 10 * np.log10(mean)
    near = np.median(np.lib.stride_tricks.sliding_window_view(np.pad(db, 8, mode="edge"), 17), axis=1)
    top = int(mean[1:].argmax()) + 1
    over = [mean[k * top - k : k * top + k + 1].max() for k in range(2, 6) if k * top + k < len(mean)]
    heard = np.flatnonzero(db > db.max() - 60)
    return {
        "holes": float((db < near - 20).sum()), "distortion": float(np.sqrt(sum(over) / mean[top])), "aliasing": float(mean[-max(1, len(mean) // 20) :].sum() / mean.sum()),
        "cutoff_hz": float(heard[-1] / (len(mean) - 1) * rate / 2) if len(heard) else 0.0,
    }


def without_reference(x: np.ndarray, rate: int) -> dict[str, float]:
    """Quality without a clean signal: blind SNR less what its frames vary, clarity by the centroid, and a share of artifacts."""
    level = 10 * np.log10((S.frames(x, max(1, rate // 50), max(1, rate // 100)) ** 2).mean(1) + 1e-12)
    crossing = (np.diff(np.signbit(S.frames(x, max(2, rate // 50), max(1, rate // 100))), axis=1) != 0).mean(1)
    clipped, silent = float((np.abs(x) > 0.99).mean()), float((np.abs(x) < 1e-4).mean())
    steady = float(np.clip(1 - crossing.var() * 10, 0, 1))
    return {
        "snr": S.blind_snr(x, rate) - min(10.0, float(level.std()) / 4), "clarity": float(min(1.0, S.spectral_shape(x, rate)["centroid"] / 4000)),
        "artifacts": min(1.0, 0.5 * clipped + 0.3 * silent + 0.2 * (1 - steady)),
    }


def interruption_suppression(original: np.ndarray, processed: np.ndarray, rate: int) -> float:
    """Share of the time of interruptions that is gone; 1 where there was none."""
    time = lambda x: sum(b - a for a, b, _ in S.interruptions(x, rate))
    before = time(original)
    return 1.0 if before <= 0 else max(0.0, 1 - time(processed) / before)


def naturalness(original: np.ndarray, processed: np.ndarray, rate: int) -> float:
    """How much of the original is kept, 0 to 1: its spectrum, its level from frame to frame and its harmonics, a third each."""
    n = min(len(original), len(processed))
    a, b = original[:n], processed[:n]
    if n < 64 or not a.any() or not b.any():
        return 0.0
    corr = lambda p, q: float(np.clip(np.nan_to_num(np.corrcoef(p, q)[0, 1]), 0, 1)) if p.std() > 0 and q.std() > 0 else 1.0
    pa_, pb = (np.log(S.spectrum(x) + 1e-10) for x in (a, b))
    ha, hb = (harmonicity(x, rate)["hnr_db"] for x in (a, b))
    return (corr(pa_.mean(0), pb.mean(0)) + corr(pa_.mean(1), pb.mean(1)) + float(np.exp(-abs(ha - hb) / 10))) / 3


# Detectors


def resonances(x: np.ndarray, rate: int, least_db: float = 15.0) -> list[tuple[float, float, str]]:
    """Frequencies at which the mean spectrum stands out of its surroundings: (Hz, dB, ``resonance`` or ``notch``)."""
    db = 10 * np.log10(S.spectrum(x).mean(0) + 1e-12)
    near = np.median(np.lib.stride_tricks.sliding_window_view(np.pad(db, 10, mode="edge"), 21), axis=1)
    off = db - near
    out = []
    for kind, flags in (("resonance", off > least_db), ("notch", off < -least_db)):
        for a, b in S.runs(flags):
            k = a + int(np.abs(off[a:b]).argmax())
            out.append((float(k * rate / 2 / (len(db) - 1)), float(off[k]), kind))
    return sorted(out)


def spectral_vad(x: np.ndarray, rate: int) -> tuple[np.ndarray, np.ndarray]:
    """Speech flag and probability of every 20 ms frame, by the share of energy between 300 and 3,400 Hz and how far it is from flat."""
    size = max(8, rate // 50)
    p = np.abs(np.fft.rfft(S.frames(x, size, size) * np.hanning(size), axis=1)) ** 2 + 1e-12
    freq = np.fft.rfftfreq(size, 1 / rate)
    band = p[:, (freq >= 300) & (freq <= 3400)].sum(1) / p.sum(1)
    flat = np.exp(np.log(p).mean(1)) / p.mean(1)
    loud = p.sum(1) > 4 * np.percentile(p.sum(1), 10)
    probability = np.clip(0.5 * band + 0.5 * (1 - flat), 0, 1) * np.where(loud, 1.0, 0.5)
    return probability > 0.5, probability


def hybrid_vad(x: np.ndarray, rate: int, detectors: Sequence[Callable] = (S.energy_vad, spectral_vad)) -> tuple[np.ndarray, float]:
    """Speech flag of every 20 ms frame by the mean probability of all detectors, and the mean sureness."""
    mean = np.mean([d(x, rate)[1] for d in detectors], axis=0)
    return mean > 0.5, float(np.maximum(mean, 1 - mean).mean()) if len(mean) else 0.0


def simultaneous_speech(x: np.ndarray, rate: int, least: float = 0.1) -> list[tuple[float, float, float]]:
    """Stretches in which something tonal is left when the harmonics of a frame's fundamental are taken out: start, end, share of the rest."""
    size, hop = max(64, int(0.064 * rate)), max(1, rate // 50)
    f = S.frames(x, size, hop)
    f0, _ = _periods(f, rate, 70.0, 400.0)
    p = np.abs(np.fft.rfft(f * np.hanning(size), axis=1)) ** 2 + 1e-15
    freq = np.fft.rfftfreq(size, 1 / rate)
    voices = (freq >= 70) & (freq <= 2000)
    p, freq = p[:, voices], freq[voices]
    off = np.abs(freq[None] - np.round(freq[None] / f0[:, None]) * f0[:, None])
    rest = np.where(off > np.minimum(2 * rate / size, 0.45 * f0[:, None]), p, 0)
    share = rest.sum(1) / p.sum(1)
    tonal = np.exp(np.log(p).mean(1)) / p.mean(1) < 0.1
    sounding = p.sum(1) > 0.01 * p.sum(1).max(initial=1e-12)
    out: list[list[float]] = []
    for a, b in S.runs((share > 0.1) & tonal & sounding & (p.sum(1) > 1e-6)):
        start, end, sure = a * hop / rate, ((b - 1) * hop + size) / rate, float(share[a:b].mean())
        if out and start - out[-1][1] <= 0.05:
            out[-1][1], out[-1][2] = end, max(out[-1][2], sure)
        else:
            out.append([start, end, sure])
    return [tuple(r) for r in out if r[1] - r[0] >= least]


def voice_vector(x: np.ndarray, rate: int) -> np.ndarray:
    """A unit vector of a voice without a model: mean and spread of its cepstrum, without the coefficient that is the level."""
    c = S.cepstra(x, rate)
    v = np.r_[c[:, 1:].mean(0), c[:, 1:].std(0)]
    size = np.linalg.norm(v)
    return v / size if size > 0 else v


def diarised(x: np.ndarray, rate: int, least: float = 0.7, window: float = 0.5) -> list[tuple[float, float, int]]:
    """Who speaks when: windows of the voiced stretches of 0.3 s or more, clustered by voice vector with average linkage.

    Speakers are numbered by first appearance. Neighbouring windows of a speaker are one segment.
    """
    flags, _ = hybrid_vad(x, rate)
    pieces = []
    for a, b in S.speech_segments(flags, 0.02, len(x) / rate):
        if b - a >= 0.3 - 1e-9:
            n = max(1, int((b - a) / window))
            edges = np.linspace(a, b, n + 1)
            pieces += list(zip(edges[:-1], edges[1:], strict=True))
    if not pieces:
        return []
    vectors = np.stack([voice_vector(x[int(a * rate) : int(b * rate)], rate) for a, b in pieces])
    groups = [[i] for i in range(len(pieces))]
    while len(groups) > 1:
        mean = np.stack([vectors[g].mean(0) for g in groups])
        near = mean @ mean.T
        np.fill_diagonal(near, -2)
        i, j = sorted(np.unravel_index(near.argmax(), near.shape))
        if near[i, j] < least:
            break
        groups[i] += groups.pop(j)
    of = {i: k for k, g in enumerate(sorted(groups, key=min)) for i in g}
    out: list[list] = []
    for i, (a, b) in enumerate(pieces):
        if out and out[-1][2] == of[i] and a - out[-1][1] <= 0.3:
            out[-1][1] = float(b)
        else:
            out.append([float(a), float(b), of[i]])
    return [tuple(r) for r in out]


def secondary_speech(x: np.ndarray, rate: int, least: float = 0.1, longest: float = 5.0) -> list[tuple[float, float, float]]:
    """Stretches that aren't the dominant voice, by votes: another speaker, another level, or two fundamentals at once; two votes of three count."""
    turns = diarised(x, rate)
    if not turns:
        return []
    time: dict[int, float] = {}
    for a, b, k in turns:
        time[k] = time.get(k, 0.0) + b - a
    main = max(time, key=lambda k: (time[k], -k))
    level = lambda a, b: float(np.sqrt((x[int(a * rate) : max(int(a * rate) + 1, int(b * rate))] ** 2).mean()))
    usual = np.median([level(a, b) for a, b, k in turns if k == main])
    both = simultaneous_speech(x, rate)
    out = []
    for a, b, k in turns:
        votes = (k != main) + (not 0.5 <= level(a, b) / max(usual, 1e-12) <= 2) + any(p < b and q > a for p, q, _ in both)
        if votes >= 2 and least <= b - a <= longest:
            out.append((a, b, votes / 3))
    return out


def scenario(x: np.ndarray, rate: int) -> str:
    """silence, noise, music, overlapping, dialogue or single: the first of these rules that holds."""
    if np.sqrt((x**2).mean()) < 1e-3:
        return "silence"
    shape, voice = S.spectral_shape(x, rate), harmonicity(x, rate)
    flags, _ = hybrid_vad(x, rate)
    if shape["flatness"] > 0.3 and voice["voiced_share"] < 0.3:
        return "noise"
    if voice["voiced_share"] > 0.9 and flags.mean() > 0.95 and voice["jitter"] < 0.005:
        return "music"
    overlap = sum(b - a for a, b, _ in simultaneous_speech(x, rate))
    if overlap > 0.2 * len(x) / rate:
        return "overlapping"
    return "dialogue" if len({k for *_, k in diarised(x, rate)}) > 1 else "single"


def ending(x: np.ndarray, rate: int, seconds: float = 1.0, ratio: float = 1.3) -> tuple[bool, float]:
    """Whether the last second is so much louder than the rest, as when someone cuts in at the end, and the ratio of energies."""
    at = max(0, len(x) - int(seconds * rate))
    body, end = x[:at], x[at:]
    if not len(body) or not len(end):
        return False, 1.0
    r = float((end**2).mean() / max((body**2).mean(), 1e-12))
    return r > ratio, r


# Filters


def faded(x: np.ndarray, rate: int, stretches: Sequence[tuple[float, float]], gain_db: float = -40.0, fade: float = 0.05) -> np.ndarray:
    """The signal with stretches turned down, and ramps so long at their edges."""
    mask = np.ones(len(x))
    low, n = 10 ** (gain_db / 20), max(1, int(fade * rate))
    for a, b in stretches:
        mask[max(0, int(a * rate)) : max(0, int(b * rate))] = low
    ramp = np.pad(mask, n, mode="edge")
    sums = np.cumsum(np.r_[0.0, ramp])
    return x * np.minimum(mask, (sums[2 * n + 1 :] - sums[: -2 * n - 1]) / (2 * n + 1)) if len(x) else x


def without_secondary(x: np.ndarray, rate: int) -> np.ndarray:
    """The signal with stretches of other voices turned down (see :func:`secondary_speech`)."""
    return faded(x, rate, [(a, b) for a, b, _ in secondary_speech(x, rate)])


def dominant_only(x: np.ndarray, rate: int, least: float = 0.0) -> np.ndarray:
    """The voice with most speaking time alone: what others say is turned down. Under ``least`` seconds of it the signal stays."""
    turns = diarised(x, rate)
    time: dict[int, float] = {}
    for a, b, k in turns:
        time[k] = time.get(k, 0.0) + b - a
    if len(time) < 2 or max(time.values()) < least:
        return x
    main = max(time, key=lambda k: (time[k], -k))
    return faded(x, rate, [(a, b) for a, b, k in turns if k != main])


def voice_band(x: np.ndarray, rate: int, low: float = 250.0, high: float = 3500.0, outside: float = 0.3) -> np.ndarray:
    """Frequencies outside the band of voices turned down."""
    freq = np.fft.rfftfreq(512, 1 / rate)
    return S._gained(x, lambda p: np.where((freq >= low) & (freq <= high), 1.0, outside))


def quiet_ending(x: np.ndarray, rate: int, seconds: float = 3.0, only_if_louder: bool = True) -> np.ndarray:
    """The end turned down if it is louder than the rest, or in any case; in signals longer than it alone."""
    if len(x) <= seconds * rate or (only_if_louder and not ending(x, rate, seconds)[0]):
        return x
    return faded(x, rate, [(len(x) / rate - seconds, len(x) / rate)])


def harmonic_enhanced(x: np.ndarray, rate: int, gain: float = 1.5) -> np.ndarray:
    """Harmonics of the median fundamental raised, if there is one."""
    f0, _ = pitch(x, rate)
    if not (f0 > 0).any():
        return x
    base = float(np.median(f0[f0 > 0]))
    freq = np.fft.rfftfreq(512, 1 / rate)
    off = np.abs(freq / base - np.round(freq / base))
    comb = np.where((off < 0.2) & (freq > base / 2), gain, 1.0)
    out = S._gained(x, lambda p: comb)
    return out * (np.sqrt((x**2).mean()) / max(np.sqrt((out**2).mean()), 1e-12))


def perceptual(x: np.ndarray, rate: int, emphasis: float = 0.1, ratio: float = 0.7, comfort_db: float = -70.0) -> np.ndarray:
    """A little treble, softer dynamics, and a noise floor so low that it isn't heard (the same for every signal)."""
    y = x + emphasis * np.append(0.0, np.diff(x)) if len(x) else x
    peak = np.abs(y).max(initial=0.0)
    if peak < 1e-10:
        return x
    y = np.sign(y) * (np.abs(y) / peak) ** ratio * peak
    y *= np.sqrt((x**2).mean()) / max(np.sqrt((y**2).mean()), 1e-12)
    return np.clip(y + 10 ** (comfort_db / 20) * np.random.default_rng(5).standard_normal(len(y)), -1, 1)


def repaired(x: np.ndarray, rate: int) -> np.ndarray:
    """Clicks and clipped runs replaced by straight lines between their ends."""
    bad = np.zeros(len(x), bool)
    size = max(1, rate // 1000)
    for a, b, kind in S.clicks(x, rate):
        if kind == "click":
            bad[a * size : (b + 1) * size] = True
    for a, b in S.clipped_runs(x):
        bad[a:b] = True
    if not bad.any() or bad.all():
        return x
    out, at = x.copy(), np.arange(len(x))
    out[bad] = np.interp(at[bad], at[~bad], x[~bad])
    return out


def smoothed(x: np.ndarray, rate: int, width: int = 5) -> np.ndarray:
    """Gains of neighbouring frequencies evened out, against single tones that filters leave behind."""

    def gain(p: np.ndarray) -> np.ndarray:
        even = np.apply_along_axis(lambda r: np.convolve(np.pad(r, width // 2, mode="edge"), np.ones(width) / width, "valid"), 1, p)
        return np.sqrt(np.minimum(1.0, 4 * even / np.maximum(p, 1e-20)))

    return S._gained(x, gain)


def until_snr(x: np.ndarray, rate: int, target: float = 35.0, rounds: int = 3, least: float = 0.85, steps: Sequence[Callable] = (S.gated, S.wiener, S.subtracted)) -> np.ndarray:
    """Filters one after the other until the blind SNR is reached: one that costs too much naturalness ends it, one without gain too."""
    best, snr = x, S.blind_snr(x, rate)
    for _ in range(rounds):
        before = snr
        for step in steps:
            if snr >= target:
                return best
            y = step(best)
            if naturalness(x, y, rate) < least:
                return best
            if (now := S.blind_snr(y, rate)) > snr:
                best, snr = y, now
        if snr <= before:
            break
    return best


def adaptive(x: np.ndarray, rate: int) -> np.ndarray:
    """As much filtering as the noise asks for: none from 35 dB, a gate from 25, with Wiener's filter from 15, else all until 35."""
    snr = S.blind_snr(x, rate)
    if snr >= 35:
        return x
    if snr >= 25:
        return S.gated(x)
    return S.wiener(S.gated(x)) if snr >= 15 else until_snr(x, rate)


def primary_source(sources: Sequence[np.ndarray], rate: int) -> int:
    """Which of several separated sources is the main voice: most votes of energy, voiced time and speech time; the first of equals."""
    energy = [float((s**2).sum()) for s in sources]
    voiced = [harmonicity(s, rate)["voiced_share"] for s in sources]
    spoken = [float(hybrid_vad(s, rate)[0].sum()) for s in sources]
    votes = np.zeros(len(sources))
    for values in (energy, voiced, spoken):
        votes[int(np.argmax(values))] += 1
    return int(votes.argmax())


def voice_features(x: np.ndarray, rate: int) -> dict[str, float]:
    """Measures of voices and disturbances of a signal, for :func:`signals.measured`."""
    turns = diarised(x, rate)
    return {
        "lufs": loudness(x, rate), **harmonicity(x, rate), **spectral_anomalies(x, rate), **{f"free_{k}": v for k, v in without_reference(x, rate).items()},
        "n_resonances": float(len(resonances(x, rate))), "speech_share": float(hybrid_vad(x, rate)[0].mean()), "n_speakers": float(len({k for *_, k in turns})),
        "overlap_seconds": float(sum(b - a for a, b, _ in simultaneous_speech(x, rate))), "loud_end": ending(x, rate, len(x) / rate / 4)[1],
    }
