"""Small configuration files, read on the driver."""

from __future__ import annotations

import configparser
from collections.abc import Callable
from dataclasses import dataclass


def parse_ini(text: str) -> dict[str, dict]:
    """Sections as dictionaries; True, true, False and false become booleans."""
    parser = configparser.ConfigParser()
    parser.optionxform = str
    parser.read_string(text)
    as_bool = {"True": True, "true": True, "False": False, "false": False}
    return {s: {k: as_bool.get(v, v) for k, v in parser[s].items()} for s in parser.sections()}


@dataclass(frozen=True)
class Option:
    mandatory: bool = False
    test: Callable[[str], bool] | None = None
    required: str = ""


def check_ini(config: dict[str, dict], options: dict[str, dict[str, Option]]) -> list[str]:
    """What is wrong: unknown and missing sections and options, and values that fail their test."""
    wrong = [f"unknown section {s}" for s in config if s not in options]
    for section, own in options.items():
        have = config.get(section)
        if have is None:
            if any(o.mandatory for o in own.values()):
                wrong.append(f"missing section {section}")
            continue
        wrong += [f"unknown option {section}.{k}" for k in have if k not in own]
        for name, option in own.items():
            if option.mandatory and name not in have:
                wrong.append(f"missing option {section}.{name}")
            elif name in have and option.test and not option.test(str(have[name])):
                wrong.append(f"{section}.{name} = {have[name]}: {option.required or 'not valid'}")
    return wrong


def resolve(defaults: dict, ini_platform: dict, command_line: dict, ini_general: dict) -> dict:
    """Settings in rising precedence: defaults, the platform's section, the command line, [general]; then the command line's run, platform and input_dir."""
    given = {k: v for k, v in command_line.items() if v is not None}
    out = {**defaults, **ini_platform, **given, **ini_general}
    return out | {k: given[k] for k in ("run", "platform", "input_dir") if k in given}
