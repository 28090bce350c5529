"""Values fixed by the published S2 cell definition and by the result contract."""

# --- fixed values -----------------------------------------------------------
EARTH_RADIUS_M = 6371009.0
MAX_LEVEL = 30
# Hilbert curve: position along the curve -> 2*i + j, per orientation, and the
# orientation change that each position causes.
POS_TO_IJ = [[0, 1, 3, 2], [0, 2, 3, 1], [3, 2, 0, 1], [3, 1, 0, 2]]
POS_TO_ORIENTATION = [1, 0, 0, 3]
UV_MARGIN = 2.0**-52
# ----------------------------------------------------------------------------


def _walk(orientation: int, digits: list[int], forward: bool) -> tuple[list[int], int]:
    """Follow the curve for some base-4 digits (ij -> pos when ``forward``)."""
    out = []
    for d in digits:
        pos = POS_TO_IJ[orientation].index(d) if forward else d
        out.append(pos if forward else POS_TO_IJ[orientation][pos])
        orientation ^= POS_TO_ORIENTATION[pos]
    return out, orientation


def ij_table() -> list[int]:
    """Two curve levels at once: [orientation, 2 bits of i, 2 bits of j] -> pos<<2 | orientation."""
    table = []
    for orientation in range(4):
        for i in range(4):
            for j in range(4):
                digits = [(i >> 1) * 2 + (j >> 1), (i & 1) * 2 + (j & 1)]
                (hi, lo), after = _walk(orientation, digits, forward=True)
                table.append(((hi * 4 + lo) << 2) | after)
    return table


def pos_table() -> list[int]:
    """The inverse: [orientation, 4 bits of position] -> i<<4 | j<<2 | orientation."""
    table = []
    for orientation in range(4):
        for pos in range(16):
            (hi, lo), after = _walk(orientation, [pos >> 2, pos & 3], forward=False)
            i = (hi >> 1) * 2 + (lo >> 1)
            j = (hi & 1) * 2 + (lo & 1)
            table.append((i << 4) | (j << 2) | after)
    return table
