"""Plain-Python model of the trip-distance rules, used as a brute-force check."""

from __future__ import annotations

import math


def dist_m(lng1, lat1, lng2, lat2) -> int:
    def rad(d):
        return d * math.pi / 180.0

    a = rad(lat1) - rad(lat2)
    b = rad(lng1) - rad(lng2)
    s = 2 * math.asin(math.sqrt(math.pow(math.sin(a / 2), 2)
                                + math.cos(rad(lat1)) * math.cos(rad(lat2)) * math.pow(math.sin(b / 2), 2)))
    s = s * 6378.137
    s = math.floor(s * 10000 + 0.5) / 10000
    return int(s * 1000)


def exact_fold(legs) -> int:
    """legs: list of legs, each a list of (lng, lat) or None, ordered by line position.
    The sequential rule: a missing end is replaced by the same end of the last measured pair."""
    last_a = last_b = None
    total = 0
    for leg in legs:
        for x in range(len(leg) - 1):
            a, b = leg[x], leg[x + 1]
            if a is None:
                a = last_a
            if b is None:
                b = last_b
            if a is not None and b is not None:
                last_a, last_b = a, b
                total += dist_m(a[0], a[1], b[0], b[1])
    return total


def bridge(legs) -> int:
    """Inside each leg, measure each located station from the last located one before it."""
    total = 0
    for leg in legs:
        prev = None
        for p in leg:
            if p is None:
                continue
            if prev is not None:
                total += dist_m(prev[0], prev[1], p[0], p[1])
            prev = p
    return total
