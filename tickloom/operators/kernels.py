"""Bars as kernels over arrays, with state carried from batch to batch.

A kernel takes the trades of one symbol in order, in pieces of any size, and gives the bars that close in each piece.
Sums run in the order of the trades (``cumsum`` from the carried value), so results don't depend on how trades are
cut into pieces.
"""

from __future__ import annotations

import numpy as np

#: Trades looked at first for the end of a bar; doubled while it isn't among them.
LOOK = 256


def running(start: float, values: np.ndarray) -> np.ndarray:
    """Sums after each value, added one by one to ``start``."""
    return np.cumsum(np.concatenate([[start], values]))[1:]


class Bar:
    """What a bar holds so far."""

    __slots__ = ("buy", "close", "end", "high", "low", "open", "start", "theta", "ticks", "ticks_buy", "usd", "volume")

    def __init__(self):
        self.ticks = self.ticks_buy = 0
        self.open = self.close = float("nan")
        self.high, self.low = float("-inf"), float("inf")
        self.start = self.end = 0
        self.theta = self.buy = self.usd = self.volume = 0.0

    def add(self, price, ms, net, side, qty) -> None:
        if not self.ticks:
            self.open, self.start = float(price[0]), int(ms[0])
        self.high, self.low = max(self.high, float(price.max())), min(self.low, float(price.min()))
        self.close, self.end = float(price[-1]), int(ms[-1])
        bought = side > 0
        self.ticks += len(price)
        self.ticks_buy += int(bought.sum())
        self.theta = float(running(self.theta, net)[-1])
        self.usd = float(running(self.usd, np.abs(net))[-1])
        self.volume = float(running(self.volume, qty)[-1])
        if bought.any():
            self.buy = float(running(self.buy, net[bought])[-1])

    def row(self) -> tuple:
        return self.start, self.end, self.open, self.high, self.low, self.close, self.theta, self.buy, self.usd, self.volume


class Kernel:
    """One symbol's bars. Subclasses say where a bar ends and what its row is."""

    def __init__(self):
        self.bar, self.count = Bar(), 0

    def ends(self, net: np.ndarray, qty: np.ndarray, side: np.ndarray) -> int:
        """Index of the trade that closes the bar, -1 if none of these does."""
        raise NotImplementedError

    def closed(self) -> tuple:
        """The row of the bar that has just closed; adapts what the kernel has learnt."""
        return *self.bar.row(), self.bar.ticks, self.bar.ticks_buy

    def step(self, price, ms, net, side, qty) -> list[tuple]:
        out, at, n = [], 0, len(price)
        while at < n:
            look = LOOK
            while True:
                stop = min(n, at + look)
                end = self.ends(net[at:stop], qty[at:stop], side[at:stop])
                if end >= 0 or stop == n:
                    break
                look *= 2
            stop = at + end + 1 if end >= 0 else n
            self.bar.add(price[at:stop], ms[at:stop], net[at:stop], side[at:stop], qty[at:stop])
            at = stop
            if end >= 0:
                out.append((self.count, *self.closed()))
                self.count += 1
                self.bar = Bar()
        return out

    def partial(self) -> list[tuple]:
        """The row of the bar that is still open, if it has trades."""
        return [(self.count, *self.bar.row(), self.bar.ticks, self.bar.ticks_buy)] if self.bar.ticks else []


class Standard(Kernel):
    """Bars of ``threshold`` in quote currency; the trade that reaches it belongs to the bar, what is over is lost."""

    def __init__(self, threshold: float):
        super().__init__()
        self.threshold = threshold

    def ends(self, net, qty, side):
        sums = running(self.bar.usd, np.abs(net))
        at = int(np.searchsorted(sums, self.threshold, "left"))
        return at if at < len(sums) else -1


class Volume(Kernel):
    """Bars of ``threshold`` in traded quantity."""

    def __init__(self, threshold: float):
        super().__init__()
        self.threshold = threshold

    def ends(self, net, qty, side):
        at = int(np.searchsorted(running(self.bar.volume, qty), self.threshold, "left"))
        return at if at < len(qty) else -1


class Imbalance(Kernel):
    """Bars that close when the signed flow leaves its expected size.

    The first bar, and any after one that took longer than ``time_reset`` hours, closes on ``init_ticks`` trades.
    """

    def __init__(self, init_ticks: float = 1000, alpha_ticks: float = 0.9, alpha_imbalance: float = 0.9, time_reset: float = 5.0):
        super().__init__()
        self.init_ticks, self.alpha_ticks, self.alpha_imbalance = init_ticks, alpha_ticks, alpha_imbalance
        self.reset_ms = 3_600_000.0 * time_reset
        self.warm, self.threshold = True, float(init_ticks)
        self.ewma_t, self.ewma_imbalance = float(init_ticks), 0.0

    def ends(self, net, qty, side):
        if self.warm:
            at = max(0, int(np.ceil(self.threshold)) - self.bar.ticks - 1)
            return at if at < len(net) else -1
        over = np.abs(self.flows(net, side)) >= self.threshold
        at = int(over.argmax())
        return at if over[at] else -1

    def flows(self, net, side):
        """The bar's flow after each of these trades."""
        return running(self.bar.theta, net)

    def flow(self) -> float:
        return self.bar.theta

    def closed(self):
        b = self.bar
        flow = abs(self.flow())
        if self.warm:
            self.ewma_t, self.ewma_imbalance, self.warm = float(b.ticks), flow / b.ticks, False
        else:
            self.ewma_t += self.alpha_ticks * (b.ticks - self.ewma_t)
            self.ewma_imbalance += self.alpha_imbalance * (flow / b.ticks - self.ewma_imbalance)
        row = *super().closed(), self.ewma_t, self.ewma_imbalance
        if b.end - b.start > self.reset_ms:
            self.warm, self.threshold = True, float(self.init_ticks)
        else:
            self.threshold = self.ewma_t * self.ewma_imbalance
        return row

    def partial(self):
        return [(*r, self.ewma_t, self.ewma_imbalance) for r in super().partial()]


class TickImbalance(Imbalance):
    """Imbalance bars (an extension) whose flow is bought trades less sold ones, whatever their sizes."""

    def flows(self, net, side):
        return running(self.flow(), side)

    def flow(self):
        return float(2 * self.bar.ticks_buy - self.bar.ticks)


class VolumeImbalance(Kernel):
    """The older variant: expectations in quote volume, seeded by the first bar (and again whenever the share is 1)."""

    def __init__(self, init_t: float, alpha_volume: float = 0.1, alpha_imbalance: float = 0.1, init_dif: float = 1.0):
        super().__init__()
        self.expected, self.dif = init_t, init_dif
        self.alpha_volume, self.alpha_imbalance = alpha_volume, alpha_imbalance
        self.threshold = init_t * abs(init_dif)
        self.trace: list[tuple] = []

    def ends(self, net, qty, side):
        over = np.abs(running(self.bar.theta, net)) >= self.threshold
        at = int(over.argmax())
        return at if over[at] else -1

    def closed(self):
        b = self.bar
        share = abs(2 * b.buy / b.usd - 1) if b.usd else 1.0
        if self.dif == 1.0:
            self.expected, self.dif = b.usd, share
        else:
            self.expected += self.alpha_volume * (b.usd - self.expected)
            self.dif += self.alpha_imbalance * (share - self.dif)
        self.threshold = self.expected * abs(self.dif)
        self.trace.append((self.count, self.expected, self.dif, self.threshold))
        return b.row()

    def partial(self):
        return [(self.count, *self.bar.row())] if self.bar.ticks else []


class Run(Kernel):
    """Run bars (an extension): close when the larger one-sided flow reaches its expected size.

    Expectation: mean bar volume times the larger share of one side, both moving averages; a bar longer than
    ``time_reset`` hours brings back the initial threshold.
    """

    def __init__(self, init_t: float = 1e9, alpha_volume: float = 0.1, alpha_imbalance: float = 0.1, time_reset: float = 4.0):
        super().__init__()
        self.init_t, self.threshold = init_t, init_t
        self.alpha_volume, self.alpha_imbalance, self.reset_ms = alpha_volume, alpha_imbalance, 3_600_000.0 * time_reset
        self.expected = self.share = None

    def ends(self, net, qty, side):
        buy = running(self.bar.buy, np.maximum(net, 0.0))
        usd = running(self.bar.usd, np.abs(net))
        over = np.maximum(buy, usd - buy) >= self.threshold
        at = int(over.argmax())
        return at if over[at] else -1

    def closed(self):
        b = self.bar
        share = max(b.buy, b.usd - b.buy) / b.usd if b.usd else 1.0
        if self.expected is None:
            self.expected, self.share = b.usd, share
        else:
            self.expected += self.alpha_volume * (b.usd - self.expected)
            self.share += self.alpha_imbalance * (share - self.share)
        self.threshold = self.init_t if b.end - b.start > self.reset_ms else self.expected * self.share
        return super().closed()
