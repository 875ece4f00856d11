"""The alert rules in plain Python, written from their description, for comparison."""


def alerts_of(readings, min_consecutive=3, cooldown_ms=30_000):
    """``readings``: (sensor, seq, event_ms, breach). Returns {(sensor, seq): run length}."""
    runs, last, found = {}, {}, {}
    for sensor, seq, event_ms, breach in sorted(readings, key=lambda r: r[1]):
        runs[sensor] = runs.get(sensor, 0) + 1 if breach else 0
        due = event_ms - last.get(sensor, 0) > cooldown_ms
        if runs[sensor] >= min_consecutive and due:
            last[sensor] = event_ms
            found[sensor, seq] = runs[sensor]
    return found


def runs_of(readings):
    """{(sensor, seq): (run length, first seq of the run)} of all breaches."""
    state, found = {}, {}
    for sensor, seq, _, breach in sorted(readings, key=lambda r: r[1]):
        length, begin = state.get(sensor, (0, None))
        state[sensor] = (length + 1, seq if length == 0 else begin) if breach else (0, None)
        if breach:
            found[sensor, seq] = state[sensor]
    return found
