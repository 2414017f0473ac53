"""The pipeline's configuration: JSON sections, checked, as a typed plan."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

#: Defaults by instrument.
DEFAULTS = {"lattice": {"angle": 31.8, "xy-res": 0.104, "estimate": 10}, "adaptive": {"angle": 147.55, "xy-res": 0.108, "estimate": 250}}
#: Options of each section, with the type each must have. A float must be written as one.
OPTIONS: dict[str, dict[str, type]] = {
    "flatfield": {"xy-res": float, "bit-depth": int, "executable_path": str},
    "crop": {"cropTop": int, "cropBottom": int, "cropLeft": int, "cropRight": int, "cropFront": int, "cropBack": int, "xy-res": float, "bit-depth": int, "executable_path": str},
    "deskew": {"angle": float, "xy-res": float, "fill": float, "bit-depth": int, "executable_path": str},
    "decon": {"n": int, "subtract": float, "xy-res": float, "bit-depth": int, "executable_path": str},
    "mip": {"x": bool, "y": bool, "z": bool, "executable_path": str},
    "bdv": {"bdv_save": bool, "overwrite": bool},
    "bsub": {"o": str, "We": int, "n": int, "P": str, "W": int, "J": str},
}


class ConfigError(ValueError):
    pass


@dataclass
class Plan:
    instrument: str
    root: str
    flatfield: dict[str, Any] | None = None
    crop: dict[str, Any] | None = None
    deskew: dict[str, Any] | None = None
    decon: dict[str, Any] | None = None
    decon_first: dict[str, dict[str, Any]] | None = None
    mip: str = ""
    psf: dict[str, str] = field(default_factory=dict)
    calibration: dict[str, str] = field(default_factory=dict)
    bdv_save: bool = False
    overwrite: bool = True
    cluster: dict[str, Any] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)

    def stages(self) -> list[tuple[str, str]]:
        """(stage, input) in the order they run. Projections follow the last of the stages before
        them; of intermediate stages only where nothing deskews."""
        out: list[tuple[str, str]] = []
        last = "raw"
        for name in ("flatfield", "crop"):
            if getattr(self, name) is not None:
                out.append((name, last))
                last = name
        if self.mip and self.deskew is None and self.decon_first is None:
            out.append((f"mip:{self.mip}", last))
        if self.decon_first is not None:
            out += [("decon_first.decon", last), ("decon_first.deskew", "decon_first.decon")]
            if self.mip:
                out.append((f"mip:{self.mip}", "decon_first.deskew"))
        if self.deskew is not None:
            out.append(("deskew", last))
            last = "deskew"
            if self.mip:
                out.append((f"mip:{self.mip}", "deskew"))
        if self.decon is not None:
            out.append(("decon", last))
            if self.mip:
                out.append((f"mip:{self.mip}", "decon"))
        return out

    def explain(self) -> str:
        """A line for each stage, as a dry run shows them."""
        return "\n".join(f"{source} -> {stage}" for stage, source in self.stages())


def _section(name: str, given: Any, plan: Plan, defaults: dict[str, Any]) -> dict[str, Any]:
    if not isinstance(given, dict):
        raise ConfigError(f"{name}: an object is expected")
    out = dict(defaults)
    for key, value in given.items():
        kind = OPTIONS[name.rpartition(".")[2]].get(key)
        if kind is None:
            plan.warnings.append(f"{name}.{key} is not known and does not count")
        elif type(value) is not kind:
            raise ConfigError(f"{name}.{key}: {kind.__name__} is expected, not {value!r}")
        elif key == "bit-depth" and value not in (8, 16, 32):
            raise ConfigError(f"{name}.bit-depth: 8, 16 or 32")
        else:
            out[key] = value
    return out


def parse_config(text: str, instrument: str = "lattice") -> Plan:
    """A Plan from JSON text; ConfigError says what is wrong. Absent bdv and bsub sections have defaults."""
    given = json.loads(text)
    if "root" not in given.get("paths", {}):
        raise ConfigError("paths.root is required")
    d = DEFAULTS[instrument]
    plan = Plan(instrument, given["paths"]["root"], cluster={"n": 4, "o": "/dev/null", "W": 480, "We": d["estimate"]})
    res = {"xy-res": d["xy-res"], "bit-depth": 16}
    defaults = {"flatfield": {"xy-res": 0.108, "bit-depth": 16}, "crop": res | dict.fromkeys(("cropTop", "cropBottom", "cropLeft", "cropRight", "cropFront", "cropBack"), 0), "deskew": res | {"angle": d["angle"], "fill": 0.0}, "decon": res | {"subtract": 0.0}}
    for name in ("flatfield", "crop", "deskew", "decon"):
        if name in given:
            setattr(plan, name, _section(name, given[name], plan, defaults[name]))
    if "decon-first" in given:
        both = given["decon-first"]
        if {"decon", "deskew"} - set(both):
            raise ConfigError("decon-first: decon and deskew are required")
        plan.decon_first = {k: _section(f"decon-first.{k}", both[k], plan, defaults[k]) for k in ("decon", "deskew")}
    for decon in (plan.decon, (plan.decon_first or {}).get("decon")):
        if decon is not None and "n" not in decon:
            raise ConfigError("decon.n is required")
    if "mip" in given:
        axes = _section("mip", given["mip"], plan, {})
        plan.mip = "".join(a for a in "xyz" if axes.get(a))
    if "bdv" in given:
        bdv = _section("bdv", given["bdv"], plan, {"bdv_save": False, "overwrite": True})
        plan.bdv_save, plan.overwrite = bdv["bdv_save"], bdv["overwrite"]
    if "bsub" in given:
        plan.cluster |= _section("bsub", given["bsub"], plan, {})
    paths = given["paths"]
    if plan.decon or plan.decon_first:
        psf = paths.get("psf")
        if not psf or "laser" not in psf:
            raise ConfigError("paths.psf.laser is required for decon")
        plan.psf = {k: f"{psf.get('dir') or plan.root}/{v}" for k, v in psf["laser"].items()}
    if plan.flatfield is not None:
        flat = paths.get("flatfield")
        if not flat or "dark" not in flat or "laser" not in flat:
            raise ConfigError("paths.flatfield.dark and .laser are required for flatfield")
        base = flat.get("dir") or plan.root
        plan.calibration = {"dark": f"{base}/{flat['dark']}"} | {k: f"{base}/{v}" for k, v in flat["laser"].items()}
    return plan
