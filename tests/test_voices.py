"""Kernels on whole signals: known loudness, intelligibility, pitch, voices and disturbances."""

import numpy as np
import pytest

from voxloom.functions import signals as S
from voxloom.functions import voices as V

RATE = 8000
T = np.arange(3 * RATE) / RATE


def voice(f0, shape, seconds=3.0, seed=0):
    t = np.arange(int(seconds * RATE)) / RATE
    g = np.random.default_rng(seed)
    x = sum(np.exp(-((k * f0 - shape) ** 2) / 4e5) * np.sin(2 * np.pi * k * f0 * t + g.uniform(0, 6)) for k in range(1, int(3500 / f0)))
    return 0.3 * x / np.abs(x).max() + 1e-4 * g.standard_normal(len(t))


def noise(n=len(T), level=0.1, seed=1):
    return level * np.random.default_rng(seed).standard_normal(n)


def test_loudness_of_the_standards_tone():
    tone = np.sin(2 * np.pi * 997 * np.arange(10 * 48_000) / 48_000)
    assert V.loudness(tone, 48_000) == pytest.approx(-3.01, abs=0.05) and V.loudness(0.1 * tone, 48_000) == pytest.approx(-23.01, abs=0.05)
    assert V.loudness(np.zeros(8000), RATE) == -70 and V.loudness(V.at_loudness(voice(120, 700), RATE, -30), RATE) == pytest.approx(-30, abs=0.2)
    assert (V.at_loudness(np.zeros(100), RATE) == 0).all()


def test_ratios():
    a, b, n = voice(120, 700), voice(210, 1500, seed=3), noise(level=0.01)
    assert V.si_sdr(a, 3 * a) == 100 and V.si_sdr(a, a + n) > V.si_sdr(a, a + 10 * n) and np.isnan(V.si_sdr(np.zeros(9), a))
    assert V.si_sdr_gain(a + b, a + n, a) > 10
    value, chosen = V.best_assignment([a, b], [b + n, a + n])
    assert chosen == [1, 0] and value > 15
    many = [noise(4000, seed=k) for k in range(6)]
    assert V.best_assignment(many, many[::-1])[1] == [5, 4, 3, 2, 1, 0]


def test_intelligibility_falls_with_noise():
    x = voice(120, 700) * (np.sin(2 * np.pi * 3 * T) > -0.5)
    values = [V.intelligibility(x, x + noise(level=k), RATE) for k in (0.0, 0.02, 0.2, 2.0)]
    assert values[0] == pytest.approx(1, abs=1e-3) and values == sorted(values, reverse=True) and values[-1] < 0.4
    assert V.intelligibility(x[:500], x[:500], RATE) == pytest.approx(1) and V.intelligibility(np.zeros(500), x[:500], RATE) == 0


def test_pitch_harmonics_and_formants():
    f0, _ = V.pitch(voice(150, 800), RATE)
    assert np.median(f0[f0 > 0]) == pytest.approx(150, rel=0.02)
    assert V.harmonicity(voice(150, 800), RATE)["hnr_db"] > V.harmonicity(voice(150, 800) + noise(level=0.05), RATE)["hnr_db"]
    assert V.harmonicity(noise(), RATE)["voiced_share"] < 0.2 and V.harmonicity(np.zeros(4000), RATE)["f0_mean"] == 0
    g = np.random.default_rng(4)
    x = np.zeros(RATE)
    e = g.standard_normal(RATE)
    r, w = 0.98, 2 * np.pi * 900 / RATE
    for i in range(2, len(x)):
        x[i] = e[i] + 2 * r * np.cos(w) * x[i - 1] - r * r * x[i - 2]
    assert min(abs(f - 900) for f in V.formants(x, RATE)) < 40 and V.formants(np.zeros(100), RATE) == []


def test_spectral_oddities():
    tone = noise(level=0.05) + 0.5 * np.sin(2 * np.pi * 1000 * T)
    assert [k for f, _, k in V.resonances(tone, RATE) if abs(f - 1000) < 40] == ["resonance"]
    s = np.fft.rfft(noise(level=0.1))
    f = np.fft.rfftfreq(len(T), 1 / RATE)
    assert {k for q, _, k in V.resonances(np.fft.irfft(s * (np.abs(f - 2000) > 60)), RATE)} == {"notch"}
    assert V.spectral_anomalies(np.fft.irfft(np.where(f < 2500, s, 0)), RATE)["cutoff_hz"] == pytest.approx(2500, abs=100)
    assert V.spectral_anomalies(np.clip(2 * np.sin(2 * np.pi * 400 * T), -0.9, 0.9), RATE)["distortion"] > 0.1
    bad = V.without_reference(np.clip(5 * voice(120, 700), -1, 1), RATE)
    assert 0 <= bad["artifacts"] <= 1 and bad["artifacts"] > V.without_reference(voice(120, 700), RATE)["artifacts"]


def test_voice_activity():
    x = np.r_[noise(RATE, 0.002), voice(130, 800, 1.0), noise(RATE, 0.002, 2)]
    flags, sure = V.hybrid_vad(x, RATE)
    assert flags[52:98].mean() > 0.95 and flags[:45].mean() < 0.1 and flags[105:].mean() < 0.1 and sure > 0.6
    assert V.spectral_vad(x, RATE)[0][52:98].mean() > 0.95


def test_two_voices():
    a, b, gap = voice(110, 500, 1.5), voice(230, 2200, 1.0, seed=5), noise(RATE // 2, 1e-4)
    x = np.r_[a, gap, b, gap, voice(110, 500, 1.0, seed=6)]
    turns = V.diarised(x, RATE)
    assert [k for *_, k in turns] == [0, 1, 0] and abs(turns[1][0] - 2.0) < 0.15
    y = V.dominant_only(x, RATE)
    assert (y[int(2.2 * RATE) : int(2.8 * RATE)] ** 2).mean() < 1e-3 * (x[int(2.2 * RATE) : int(2.8 * RATE)] ** 2).mean()
    assert np.allclose(y[: RATE], x[: RATE]) and np.array_equal(V.dominant_only(a, RATE), a)
    assert V.simultaneous_speech(voice(110, 500) + voice(173, 900, seed=7), RATE) and not V.simultaneous_speech(voice(110, 500), RATE)
    quiet = np.r_[a, gap, 0.2 * b, gap, voice(110, 500, 1.0, seed=6)]
    found = V.secondary_speech(quiet, RATE)
    assert len(found) == 1 and 1.8 < found[0][0] < 2.2 and np.abs(V.without_secondary(quiet, RATE)[int(2.3 * RATE) : int(2.7 * RATE)]).max() < 0.01
    assert V.primary_source([0.1 * noise(), a, 0.3 * b], RATE) == 1
    assert V.diarised(np.zeros(RATE), RATE) == [] and V.secondary_speech(np.zeros(RATE), RATE) == []


def test_scenarios_and_endings():
    assert V.scenario(np.zeros(RATE), RATE) == "silence" and V.scenario(noise(), RATE) == "noise"
    assert V.scenario(np.r_[voice(110, 500, 1.5), noise(RATE // 2, 1e-4), voice(230, 2200, 1.0, seed=5)], RATE) == "dialogue"
    loud = np.r_[voice(110, 500, 3.0) * 0.2, voice(200, 900, 1.0)]
    assert V.ending(loud, RATE)[0] and not V.ending(voice(110, 500), RATE)[0] and V.ending(loud[:100], RATE) == (False, 1.0)
    assert np.abs(V.quiet_ending(loud, RATE, 1.0)[-RATE // 2 :]).max() < 0.01 and np.array_equal(V.quiet_ending(loud[:RATE], RATE), loud[:RATE])


def test_filters_keep_length_and_help():
    x = voice(120, 700)
    for f in (V.voice_band, V.harmonic_enhanced, V.perceptual, V.repaired, V.smoothed, V.until_snr, V.adaptive, V.without_secondary, V.dominant_only, V.at_loudness):
        for y in (x, x[:100], np.zeros(700)):
            out = f(y, RATE)
            assert len(out) == len(y) and np.isfinite(out).all()
    clicked = x.copy()
    clicked[[4000, 12_000]] = 1.0
    assert np.abs(V.repaired(clicked, RATE) - x).max() < np.abs(clicked - x).max()
    dirty = x * (np.sin(2 * np.pi * 2 * T) > 0) + noise(level=0.01)
    assert S.blind_snr(V.until_snr(dirty, RATE), RATE) >= S.blind_snr(dirty, RATE)
    assert V.naturalness(x, x, RATE) == pytest.approx(1) and V.naturalness(x, noise(), RATE) < 0.7
    assert V.interruption_suppression(x, x, RATE) in (0.0, 1.0)
    assert all(np.isfinite(v) for v in V.voice_features(dirty, RATE).values())
