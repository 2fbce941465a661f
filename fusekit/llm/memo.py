"""A bounded memo for per-word work inside a task."""

from __future__ import annotations


class Memo:
    """``make(key)`` remembered for up to twice ``size`` keys.  When the young
    half is full it becomes the old half; an old key that is asked for again
    moves to the young half, so frequent keys stay."""

    def __init__(self, make, size: int):
        self.make, self.size = make, size
        self.young: dict = {}
        self.old: dict = {}

    def __getitem__(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = self.make(key)
            if len(self.young) >= self.size:
                self.young, self.old = {}, self.young
            self.young[key] = value
        return value

    def many(self, keys: list) -> list:
        """The values of ``keys``, in order."""
        out = list(map(self.young.get, keys))
        if None in out:
            for i in [i for i, value in enumerate(out) if value is None]:
                out[i] = self[keys[i]]
        return out

    def all(self, keys: list, make) -> list:
        """The values of distinct ``keys``; missing ones come from
        ``make(keys)``, all at once."""
        values = list(map(self.young.get, keys))
        late = [i for i, v in enumerate(values) if v is None]
        late_keys = [keys[i] for i in late]
        found = list(map(self.old.get, late_keys))
        gaps = [i for i, v in enumerate(found) if v is None]
        for i, v in zip(gaps, make([late_keys[i] for i in gaps])):
            found[i] = v
        at = 0
        while at < len(late_keys):
            if len(self.young) >= self.size:
                self.young, self.old = {}, self.young
            stop = at + self.size - len(self.young)
            self.young.update(zip(late_keys[at:stop], found[at:stop]))
            at = stop
        for i, v in zip(late, found):
            values[i] = v
        return values
