"""Small ratings tables with known answers."""

# Four users' ratings as user -> {item: rating}; the time column equals the rating.
TYPED_RATINGS = {
    0: {1: 4, 3: 1, 4: 5, 5: 3, 7: 3, 9: 3, 10: 3},
    1: {1: 4, 2: 5, 3: 1, 6: 4, 7: 5, 8: 1, 10: 3},
    2: {1: 4, 2: 1, 3: 1, 4: 5, 5: 3, 6: 4, 8: 1, 9: 5, 10: 3},
    3: {2: 5, 3: 1, 4: 5, 5: 3, 6: 4, 7: 5, 8: 1, 9: 5, 10: 3},
}

# Epoch seconds of users 1-5 reading items 1-5, item by item.
NEWS_TIMES = [
    1462277923, 1463455636, 1464277923, 1465277923, 1466277923,
    1467277923, 1468277923, 1469277923, 1471277923, 1472277923,
    1473277923, 1474277923, 1475277923, 1476277923, 1477277923,
    1478277923, 1479277923, 1481277923, 1482277923, 1483277923,
    1484277923, 1485277923, 1486277923, 1487277923, 1492455636,
]


def typed_rows():
    return [(u, i, r, r) for u, rated in TYPED_RATINGS.items() for i, r in rated.items()]


def news_rows():
    places = [(n % 5 + 1, n // 5 + 1) for n in range(25)]
    return [(u, i, (u * 7 + i * 3) % 11, t) for (u, i), t in zip(places, NEWS_TIMES)]
