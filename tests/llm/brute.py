"""Plain versions of what the operators promise."""


def roots(nodes, links):
    """Smallest node reachable, by repeated relabelling."""
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root
