from math import comb


def binomial_tail(n, k, p):
    return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
