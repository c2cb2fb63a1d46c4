"""Settings: defaults, a JSON file over them, environment variables over both (survey VAL-17)."""

from __future__ import annotations

import json
import os
from copy import deepcopy
from pathlib import Path

#: Settings and their defaults (fixed values).
DEFAULTS: dict = {
    "crossref": {
        "enabled": True, "email": "", "rate": 45.0, "timeout": 30, "retries": 3,
        "thresholds": {"pmid": 0.8, "journal": 0.75, "title": 0.65},
    },
    "lens": {
        "enabled": False, "api_token": "", "rate": 10.0, "timeout": 30, "retries": 3, "cache_ttl_days": 30,
        "thresholds": {"author_match": 0.7, "institution_match": 0.6, "subject_match": 0.5},
        "phases": {"authors": True, "institutions": True, "subjects": False},
    },
    "data_quality": {
        "enabled": True, "strict": False, "require_authors": True, "require_author_ids": True, "require_title": True,
        "require_year": True, "require_affiliations": True, "require_abstract": True,
    },
    "output": {"base": "output"},
    "file_handling": {"encoding": "utf-8-sig"},
}
#: Environment variables and the settings they override (fixed values).
ENVIRONMENT = {"CROSSREF_EMAIL": ("crossref", "email"), "LENS_API_TOKEN": ("lens", "api_token")}


def merged(base: dict, over: dict) -> dict:
    out = deepcopy(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else deepcopy(v)
    return out


def env_file(path: str) -> dict[str, str]:
    """[SRC-21] ``NAME=value`` lines of a file; comments, quotes and ``export`` are put aside."""
    out = {}
    if Path(path).exists():
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            name, sep, value = line.strip().removeprefix("export ").partition("=")
            if sep and name.strip() and not name.startswith("#"):
                out[name.strip()] = value.strip().strip("'\"")
    return out


def load(path: str | None = None, environ: dict[str, str] | None = None) -> dict:
    """Environment over a ``.env`` file of the working folder over the settings' file over defaults."""
    conf = DEFAULTS
    if path and Path(path).exists():
        conf = merged(conf, json.loads(Path(path).read_text(encoding="utf-8")))
    conf = deepcopy(conf)
    for name, (section, key) in ENVIRONMENT.items():
        value = (env_file(".env") | dict(os.environ) if environ is None else environ).get(name)
        if value:
            conf[section][key] = value
    validate(conf)
    return conf


def validate(conf: dict) -> None:
    """Raise ValueError for settings that cannot work."""
    email, token = conf["crossref"]["email"], conf["lens"]["api_token"]
    if email and not ("@" in email and "." in email.split("@", 1)[1]):
        raise ValueError("crossref.email is not an address")
    if token and len(token) < 10:
        raise ValueError("lens.api_token is too short")
    for section in ("crossref", "lens"):
        for key in ("rate", "timeout", "retries"):
            if not conf[section][key] > 0:
                raise ValueError(f"{section}.{key} must be positive")
        for key, value in conf[section]["thresholds"].items():
            if not 0 <= value <= 1:
                raise ValueError(f"{section}.thresholds.{key} must be from 0 to 1")


def summary(conf: dict) -> str:
    """[SUP-10] The settings in use; of a token only the last four characters."""
    token = conf["lens"]["api_token"]
    shown = f"...{token[-4:]}" if token else "none"
    return (
        f"bibliographic service: {'on' if conf['crossref']['enabled'] else 'off'}, {conf['crossref']['email'] or 'no address'}\n"
        f"patent service: {'on' if conf['lens']['enabled'] else 'off'}, token {shown}\n"
        f"quality filter: {'on' if conf['data_quality']['enabled'] else 'off'}{', strict' if conf['data_quality']['strict'] else ''}"
    )
