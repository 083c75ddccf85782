"""Model services behind the extractor boundary: their keys and settings, and the clients that are plugged in.

The library has no client of its own. A client is a function from settings to an extractor,
(row, tier) -> fields; what is fixed here is that every client is made one way: a known
service, a key that is there, temperature 0. Clients are made in the tasks, once a worker, so
that connections never travel.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass

#: The variable that holds a service's key (none: the caller must give the key).
VARIABLES = {"anthropic": "ANTHROPIC_API_KEY", "openai": "OPENAI_API_KEY", "openai_like": None}


class UnknownProvider(ValueError):
    """No such service."""


class NoKey(ValueError):
    """The service's key is missing."""


def variable(provider: str) -> str | None:
    if provider not in VARIABLES:
        raise UnknownProvider(f"{provider!r} is none of {', '.join(sorted(VARIABLES))}")
    return VARIABLES[provider]


def api_key(provider: str, env: Mapping[str, str] | None = None) -> str:
    """The service's key from the environment."""
    name = variable(provider)
    if name is None:
        raise NoKey(f"{provider!r} has no variable of its own; its key must be given")
    found = (os.environ if env is None else env).get(name, "")
    if not found:
        raise NoKey(f"{provider!r} needs {name}, which is unset or empty")
    return found


@dataclass(frozen=True)
class Extractor:
    """An extractor that makes its client at the first call in each worker."""

    client: Callable
    settings: tuple[tuple[str, object], ...]

    def __call__(self, row: dict, tier: str) -> dict:
        made = _made.get(self)
        if made is None:
            made = _made[self] = self.client(dict(self.settings))
        return made(row, tier)

    def __repr__(self) -> str:
        return f"Extractor({', '.join(f'{k}={v!r}' for k, v in self.settings if k != 'api_key')})"


_made: dict[Extractor, Callable] = {}


def create(provider: str, model: str, key: str, client: Callable, **extra) -> Extractor:
    """An extractor of a service's model. extra goes to the client as it stands (a base address, say); the temperature is 0 whatever it says."""
    variable(provider)
    if not key:
        raise NoKey(f"{provider!r} needs a key")
    if "temperature" in extra:
        raise ValueError("the temperature is fixed")
    return Extractor(client, (("provider", provider), ("model", model), ("api_key", key), ("temperature", 0), *sorted(extra.items())))
