"""Plain versions of shared steps, for comparison."""


def smallest_reachable(nodes, links):
    """Smallest node that each node reaches."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}
