"""Numeric helpers that tasks call on one block of samples."""

import numpy as np


def _sections(zeros, poles, gain):
    """Second-order sections from conjugate pairs; each row is b0 b1 b2 a1 a2."""

    def pairs(roots):
        upper = sorted([r for r in roots if r.imag > 1e-12], key=lambda r: abs(r))
        real = sorted(r.real for r in roots if abs(r.imag) <= 1e-12)
        out = [(-2 * r.real, abs(r) ** 2) for r in upper]
        for k in range(0, len(real) - 1, 2):
            out.append((-(real[k] + real[k + 1]), real[k] * real[k + 1]))
        if len(real) % 2:
            out.append((-real[-1], 0.0))
        return out

    z, p = pairs(zeros), pairs(poles)
    z += [(0.0, 0.0)] * (len(p) - len(z))
    rows = [[1.0, z[k][0], z[k][1], p[k][0], p[k][1]] for k in range(len(p))]
    for j in range(3):
        rows[0][j] *= gain
    return np.array(rows)


def bandpass_sections(low, high, rate, order=3):
    """Digital Butterworth band-pass by the bilinear transform with pre-warped edges."""
    w1, w2 = (2 * rate * np.tan(np.pi * f / rate) for f in (low, high))
    centre2, width = w1 * w2, w2 - w1
    prototype = np.exp(1j * np.pi * (2 * np.arange(1, order + 1) + order - 1) / (2 * order))
    half = prototype * width / 2
    root = np.sqrt(half**2 - centre2 + 0j)
    poles = np.concatenate([half + root, half - root])
    z = (2 * rate + poles) / (2 * rate - poles)
    gain = (width**order * (2 * rate) ** order / np.prod(2 * rate - poles)).real
    zeros = np.array([1.0, -1.0] * order, dtype=complex)
    return _sections(zeros, z, gain)


def lowpass_sections(corner, rate, ripple=1.0, stop=96.0, most=12):
    """Digital Chebyshev II low-pass whose stop band starts near ``corner``.

    The pass-band edge shrinks by one per cent until the order is small enough.
    """
    nyquist = rate / 2
    ws = np.tan(np.pi * corner / nyquist / 2)
    ratio = np.sqrt((10 ** (stop / 10) - 1) / (10 ** (ripple / 10) - 1))
    edge, order = corner / nyquist, most + 1
    while order > most:
        edge *= 0.99
        wp = np.tan(np.pi * edge / 2)
        order = int(np.ceil(np.arccosh(ratio) / np.arccosh(ws / wp)))
    natural = wp * np.cosh(np.arccosh(ratio) / order)
    warped = 4 * natural  # bilinear transform at a rate of 2
    ripple_factor = 1 / np.sqrt(10 ** (stop / 10) - 1)
    m = np.arange(-order + 1, order, 2)
    zeros = -np.conj(1j / np.sin(m[m != 0] * np.pi / (2 * order)))
    mu = np.arcsinh(1 / ripple_factor) / order
    p = -np.exp(1j * np.pi * m / (2 * order))
    poles = 1 / (np.sinh(mu) * p.real + 1j * np.cosh(mu) * p.imag)
    gain = (np.prod(-poles) / np.prod(-zeros)).real * warped ** (len(poles) - len(zeros))
    zeros, poles = zeros * warped, poles * warped
    gain = gain * (np.prod(4 - zeros) / np.prod(4 - poles)).real
    z, p = (4 + zeros) / (4 - zeros), (4 + poles) / (4 - poles)
    z = np.concatenate([z, -np.ones(len(p) - len(z))])
    return _sections(z, p, gain)


class BlockFilter:
    """A cascade of sections applied to blocks, in blocks of ``width`` samples at once.

    Exact for any state at the block's start, so a long trace can be filtered
    chunk by chunk once the state at each chunk's start is known.
    """

    def __init__(self, sections, width=64):
        self.sections, self.width, m = np.asarray(sections), width, 2 * len(sections)
        columns = [self._step(np.eye(m)[k], 0.0) for k in range(m)] + [self._step(np.zeros(m), 1.0)]
        a = np.stack([c[0] for c in columns[:m]], axis=1)
        b = columns[m][0]
        c, d = np.array([x[1] for x in columns[:m]]), columns[m][1]
        powers = [np.eye(m)]
        for _ in range(width):
            powers.append(a @ powers[-1])
        impulse = np.array([d] + [c @ powers[k] @ b for k in range(width - 1)])
        lag = np.subtract.outer(np.arange(width), np.arange(width))
        self.respond = np.where(lag >= 0, impulse[np.abs(lag)], 0.0)
        self.observe = np.stack([c @ powers[k] for k in range(width)])
        self.drive = np.stack([powers[width - 1 - k] @ b for k in range(width)], axis=1)
        self.carry = powers[width]

    def _step(self, state, x):
        state = state.copy()
        for k, (b0, b1, b2, a1, a2) in enumerate(self.sections):
            y = b0 * x + state[2 * k]
            state[2 * k] = b1 * x - a1 * y + state[2 * k + 1]
            state[2 * k + 1] = b2 * x - a2 * y
            x = y
        return state, x

    def run(self, x, state):
        """Filtered samples and the state after the last whole sub-block."""
        x = np.asarray(x, float)
        n, w = len(x), self.width
        rows = np.zeros((-(-n // w), w))
        rows.ravel()[:n] = x
        pushed = rows @ self.drive.T
        states = np.empty((len(rows), len(state)))
        state = np.asarray(state, float)
        for k in range(len(rows)):
            states[k] = state
            state = self.carry @ state + pushed[k]
        y = rows @ self.respond.T + states @ self.observe.T
        return y.ravel()[:n], state

    def after(self, chunk, state):
        """State one whole chunk of zeros later."""
        for _ in range(chunk // self.width):
            state = self.carry @ state
        return state


def hilbert_kernel(lag, n):
    """Weights by which the samples of a trace of n samples at a distance add to its Hilbert transform."""
    angle = np.pi * lag / n
    with np.errstate(divide="ignore", invalid="ignore"):
        if n % 2 == 0:
            return np.where(lag % 2 == 0, 0.0, 2 / n / np.tan(angle))
        return np.where(lag == 0, 0.0, (1 / np.tan(angle) - np.where(lag % 2 == 0, 1.0, -1.0) / np.sin(angle)) / n)


def full_correlation(a, b):
    """Row-wise full correlation: entry j is the sum of a[m+j-w+1]*b[m]."""
    w = a.shape[1]
    size = 2 * w - 1
    spectrum = np.fft.rfft(a, size, axis=1) * np.conj(np.fft.rfft(b, size, axis=1))
    return np.roll(np.fft.irfft(spectrum, size, axis=1), w - 1, axis=1)


def first_largest(c, scale):
    """Place of each row's largest entry; entries that differ by rounding alone tie, and the first one counts."""
    near = c >= c.max(axis=1, keepdims=True) - 1e-12 * scale[:, None]
    return near.argmax(axis=1)


def gaussian(y, width):
    return (np.pi * width**2) ** -0.25 * np.exp(-0.5 * y**2 / width**2)


def gabor_rows(v, lo, n, ks, width, dt, top, threshold):
    """Spectra of n numbers of a series under Gaussian windows at the positions ks; quiet windows give zeros.

    ``v`` are the samples from index ``lo`` that the windows reach; the others count as zeros.
    """
    f = np.zeros((len(ks), n))
    f[:, lo : lo + len(v)] = gaussian((lo + np.arange(len(v)) - ks[:, None]) * dt, width) * v
    spectra = np.fft.fft(f, axis=1) * dt / np.sqrt(2 * np.pi)
    spectra[np.abs(f).max(axis=1) < top * threshold] = 0
    return spectra


def correlation_rows(d, s, lo, n, ks, width, dt, top, threshold):
    """Spectra of the correlation of windowed s and d, linearly interpolated from 2n-1 to n frequencies; samples as in ``gabor_rows``."""
    if n % 2 == 0:
        raise ValueError("a series needs an odd number of samples")
    w = gaussian((lo + np.arange(len(d)) - ks[:, None]) * dt, width)
    a, b, long = w * d, w * s, 2 * n - 1
    # where the windows lie turns both spectra alike, so the samples stand at the beginning
    c = np.fft.fftshift(np.fft.fft(b, long, axis=1) * np.conj(np.fft.fft(a, long, axis=1)), axes=1)
    have, want = np.fft.fftshift(np.fft.fftfreq(long, dt)), np.fft.fftfreq(n, dt)
    at = np.clip(np.searchsorted(have, want) - 1, 0, long - 2)
    part = (want - have[at]) / (have[at + 1] - have[at])
    spectra = (c[:, at] + (c[:, at + 1] - c[:, at]) * part) * dt / np.sqrt(2 * np.pi)
    spectra[np.minimum(np.abs(a).max(axis=1), np.abs(b).max(axis=1)) < top * threshold] = 0
    return spectra


def phase_weights(c, m, min_period, max_period, dt):
    """Weight of each cell: small for quiet cells and for periods outside the band."""
    n = c.shape[1]
    nu = np.arange(n) / (n * dt)
    loud = 1 - np.exp(-((np.abs(c) / m) ** 2)) if m > 0 else np.zeros(c.shape)
    band = (1 - np.exp(-((nu * max_period) ** 2))) * np.where(nu <= 1 / min_period, 1.0, np.exp(-10 * np.abs(nu * min_period - 1)))
    return loud * band


def lifted(x, y, z, lateral, radial):
    """Four coordinates of each place, and what their squared differences count, so that they add up to the square of the scaled distance at a velocity of one.

    The radial part of a distance counts once more as a coordinate of its own: negative, if the radial length is the longer one.
    """
    lateral, radial = np.float64(lateral), np.float64(radial)
    more = 1 / radial**2 - 1 / lateral**2
    at = np.stack([x / lateral, y / lateral, z / lateral, np.sqrt(x * x + y * y + z * z) * np.sqrt(abs(more))], axis=1)
    return at, np.array([1.0, 1.0, 1.0, np.sign(more)])


def near_blocks(own, lateral, radial, most):
    """Index arrays of at most ``most`` nodes (x, y, z, velocity, ...) that lie near one another and reach equally far: halves along the longest side."""
    with np.errstate(all="ignore"):
        at, _ = lifted(*own[:3], lateral, radial)
        at = np.column_stack([at, 3 * own[3]])
        waiting, blocks = [np.arange(len(at))], []
        while waiting:
            block = waiting.pop()
            if len(block) <= most:
                blocks.append(block)
                continue
            mine = at[block]
            half = most * (-(-len(block) // most) // 2)
            order = np.argpartition(mine[:, np.argmax(mine.max(axis=0) - mine.min(axis=0))], half)
            waiting += [block[order[:half]], block[order[half:]]]
    return blocks


def gaussian_sums(own, other, lateral, radial, sums, met, blocks, shells=4, group=16):
    """Adds to ``sums`` (a row per node, a column per value) the values of the places within three sigma, times their weight.

    ``own`` are x, y, z, velocity and number of rows of the nodes, ``other`` x, y, z of the places and
    their values. Sigma is a length times the velocity. ``met`` marks nodes with a place in reach. The nodes of a block are
    worked on together, with the places in shells around their middle: a node takes the shells that it reaches, and asks
    single places only in those that lie across its reach. Distances are products of matrices; next to three sigma they are
    computed again from the coordinates. Places are looked through once for each ``group`` of blocks, what that leaves once for each block.
    """
    v, m = own[3], np.asarray(own[4], float)
    values = np.stack(other[3:], axis=1)
    some = np.flatnonzero(values.any(axis=0))  # columns of zeros add nothing
    values = np.ascontiguousarray(values[:, some])
    with np.errstate(all="ignore"):
        a, counts = lifted(*own[:3], lateral, radial)
        b, _ = lifted(*other[:3], lateral, radial)
        # a distance that is never longer: that of all four coordinates, or of x, y, z by the longer length
        exact = counts[3] >= 0
        scale = np.ones(4) if exact else np.array([lateral / radial] * 3 + [0.0])
        middle = a.mean(axis=0)
        a, b = a - middle, b - middle
        far = b * scale
        square = (far * far).sum(axis=1)
        odd = ~np.isfinite(values).all(axis=1)
        exact = exact and not odd.any()
        blur = 1e-13 * square.max(initial=0.0)

        def around(at, far, square):
            """Distances of nodes from their middle, that of the farthest place they reach, and the squared distances of places."""
            centre = (a[at] * scale).mean(axis=0)
            aside = np.sqrt(((a[at] * scale - centre) ** 2).sum(axis=1))
            most = min((aside + 3 * v[at]).max() ** 2 * (1 + 1e-9) + blur, np.finfo(float).max)
            d2 = far @ (-2 * centre)
            d2 += square
            d2 += centre @ centre
            return aside, most, d2

        for first in range(0, len(blocks), group):
            _, most, d2 = around(np.concatenate(blocks[first : first + group]), far, square)
            here = np.flatnonzero(d2 <= most)
            b_here, far_here, square_here, values_here, odd_here = b[here], far[here], square[here], values[here], odd[here]
            for at in blocks[first : first + group]:
                aside, most, d2 = around(at, far_here, square_here)
                near = np.flatnonzero(d2 <= most)
                if not len(near):
                    continue
                shell = np.clip(d2[near] * (shells / most), 0, shells - 1).astype(np.uint8)
                near = near[np.argsort(shell, kind="stable")]
                ends = np.concatenate([[0], np.cumsum(np.bincount(shell, minlength=shells))])
                radius2, three = np.arange(shells + 1) * (most / shells), 3 * v[at]
                reached = (aside + three)[:, None] ** 2 * (1 + 1e-9) + blur >= radius2[None, :-1]
                whole = (three - aside)[:, None] * (1 - 1e-9) >= np.sqrt(radius2[None, 1:] + blur) if exact else np.zeros(reached.shape, bool)
                origin = a[at].mean(axis=0)
                mine, theirs = a[at] - origin, np.empty((len(near), 6))
                np.subtract(b_here[near], origin, out=theirs[:, :4])
                theirs[:, 4] = 1
                theirs[:, 5] = (theirs[:, :4] * theirs[:, :4]) @ counts
                per = 1 / (v[at] * v[at])
                mine = np.column_stack([mine * counts * per[:, None], -0.5 * per * ((mine * mine) @ counts), -0.5 * per])
                value = values_here[near]
                total = np.zeros((len(at), len(some)))
                for k in np.flatnonzero(np.diff(ends)):
                    lo, hi = ends[k], ends[k + 1]
                    rows = np.flatnonzero(whole[:, k])
                    if len(rows):
                        w = mine[rows] @ theirs[lo:hi].T
                        total[rows] += np.exp(w, out=w) @ value[lo:hi]
                        met[at[rows]] = True
                    rows = np.flatnonzero(reached[:, k] & ~whole[:, k])
                    if len(rows):
                        w = mine[rows] @ theirs[lo:hi].T
                        inside, surely = w >= -4.5 - 1e-9, w >= -4.5 + 1e-9
                        if np.count_nonzero(inside) != np.count_nonzero(surely):
                            i, j = np.nonzero(inside & ~surely)
                            inside[i, j] = _squared([c[at[rows[i]]] for c in own[:4]], [c[here[near[lo + j]]] for c in other[:3]], lateral, radial) <= 9
                        met[at[rows]] |= inside.any(axis=1)
                        np.exp(w, out=w)
                        w *= inside
                        it = odd_here[near[lo:hi]]
                        if it.any():  # no weight of zero may meet them
                            strange = np.where(inside[:, it, None], w[:, it, None] * value[lo:hi][it], 0.0)
                            total[rows] += strange.sum(axis=1) + w[:, ~it] @ value[lo:hi][~it]
                        else:
                            total[rows] += w @ value[lo:hi]
                sums[np.ix_(at, some)] += total * m[at, None]


def _squared(own, other, lateral, radial):
    """Square of the scaled distance of nodes (x, y, z, velocity) and places, one by one."""
    (x, y, z, v), r = own, np.sqrt(own[0] * own[0] + own[1] * own[1] + own[2] * own[2])
    dx, dy, dz, dr = x - other[0], y - other[1], z - other[2], r - np.sqrt(other[0] * other[0] + other[1] * other[1] + other[2] * other[2])
    radius2 = dr * dr
    across = np.maximum(dx * dx + dy * dy + dz * dz - radius2, 0.0)
    return radius2 / (radial * v) ** 2 + across / (lateral * v) ** 2
