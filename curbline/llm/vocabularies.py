"""Files of the public tokenizers. Their folder is a parameter of every operator."""

from __future__ import annotations

import os
from importlib import import_module


def vocabulary(name: str, folder: str | None = None) -> str:
    """The path of a vocabulary file in ``folder``, or where ``public_tokenizers`` has it."""
    if folder:
        return os.path.join(folder, name)
    return import_module("public_tokenizers").path(name)
