"""The scoring rules as a plain loop over one user's events, to compare the jobs with."""


def scores(values, window=10, multiplier=1.5, fallback=1000.0, inserted=None, times=None, idle=None, start=()):
    kept, out, before = list(start), [], None
    for i, value in enumerate(values):
        if idle is not None and before is not None and times[i] - before >= idle:
            kept = []
        if times is not None:
            before = times[i]
        average = None
        if kept:
            total = 0.0
            for v in kept:
                total += v
            average = total / len(kept)
        if average is not None and average > 0:
            flag = value > average * multiplier
        else:
            flag = value > fallback
        out.append((average, flag))
        if not flag and (inserted is None or inserted[i]):
            kept = [value, *kept][:window]
    return out
