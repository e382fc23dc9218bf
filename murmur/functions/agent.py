"""Device, store and version from a user agent."""

from pyspark.sql import Column, functions as F

from murmur import fixed


def device(agent: Column, devices: list[str] = fixed.DEVICES) -> Column:
    """The last listed device the agent mentions."""
    found = [F.when(agent.contains(d), F.lit(d)) for d in reversed(devices)]
    return F.coalesce(*found, F.lit(fixed.UNKNOWN_DEVICE))


def store_of(device_name: Column, stores: dict[str, str] = fixed.DEVICE_STORE) -> Column:
    """Store of a device; empty when the device is unknown."""
    lookup = F.create_map(*[F.lit(x) for pair in stores.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, device_name), F.lit(""))


def version(agent: Column, markers: list[str] = fixed.VERSION_MARKERS) -> Column:
    """``major.minor`` after the first marker the agent holds, else 0.

    A marker at the very start does not count, and a marker followed by
    something other than ``digits.digits`` gives 0.
    """
    result = F.lit(0.0)
    for marker in reversed(markers):
        at = F.instr(agent, marker)
        token = F.substring(agent, at + F.lit(len(marker)), F.length(agent))
        number = F.regexp_extract(token, r"^(\d+\.\d+)", 1).try_cast("double")
        result = F.when(at > 1, F.coalesce(number, F.lit(0.0))).otherwise(result)
    return result
