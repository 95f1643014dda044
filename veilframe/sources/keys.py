"""Where the vault key comes from."""

from __future__ import annotations

import os
import secrets
import stat
from abc import ABC, abstractmethod


class KeyProvider(ABC):
    managed = False

    @abstractmethod
    def key(self) -> bytes: ...


class EnvironmentKey(KeyProvider):
    def __init__(self, name: str = "VEIL_VAULT_KEY"):
        self.name = name

    def key(self) -> bytes:
        value = os.environ.get(self.name)
        if not value:
            raise LookupError(f"{self.name} is not set")
        return bytes.fromhex(value)


class FileKey(KeyProvider):
    """Key file that only its owner may read."""

    def __init__(self, path: str):
        self.path = path

    def key(self) -> bytes:
        if os.stat(self.path).st_mode & (stat.S_IRWXG | stat.S_IRWXO):
            raise PermissionError(f"{self.path} is readable by others")
        with open(self.path) as file:
            return bytes.fromhex(file.read().strip())

    @staticmethod
    def generate(path: str) -> None:
        fd = os.open(path, os.O_WRONLY | os.O_CREAT | os.O_EXCL, 0o600)
        with os.fdopen(fd, "w") as file:
            file.write(secrets.token_hex(32))


class CloudKey(KeyProvider):
    """Envelope keys of a cloud service; ``open_envelope`` is the service's call."""

    managed = True

    def __init__(self, open_envelope):
        self.open_envelope = open_envelope

    def key(self) -> bytes:
        return self.open_envelope()


def resolve(spec: str, require_managed: bool = False, services: dict | None = None) -> KeyProvider:
    """``env:NAME``, ``file:PATH`` or ``service:...`` of a registered service."""
    kind, _, rest = spec.partition(":")
    if kind == "env":
        provider: KeyProvider = EnvironmentKey(rest or "VEIL_VAULT_KEY")
    elif kind == "file":
        provider = FileKey(rest)
    elif services and kind in services:
        provider = CloudKey(lambda: services[kind](rest))
    else:
        raise LookupError(f"no key provider for {spec!r}")
    if require_managed and not provider.managed:
        raise PermissionError("a managed key is required")
    return provider
