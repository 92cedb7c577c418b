"""Catalogues: which signals exist, which table they belong to, how they are
named in the wide tables.

Operators never hard-code signal names; they take a :class:`Catalog`.
``ENERGY`` is the default configuration of the electricity-market platform;
``ampere.bindings`` defines the catalogue used on the driver's test tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values of the electricity-market platform (must equal the source
# system for identical results): signal names and API ids, units, groups,
# weather regions, variables and their units, cut-over dates.
# ---------------------------------------------------------------------------
GENERATION_SIGNALS = {
    "WIND_ONSHORE": 4067, "WIND_OFFSHORE": 1225, "SOLAR": 4068, "BIOMASS": 4066,
    "HYDROPOWER": 1226, "PUMPED_STORAGE": 4070, "NATURAL_GAS": 4071, "HARD_COAL": 4069,
    "BROWN_COAL": 1223, "NUCLEAR": 1224, "OTHER_CONVENTIONAL": 1227, "OTHER_RENEWABLE": 1228,
}
LOAD_SIGNALS = {"TOTAL_CONSUMPTION": 410, "RESIDUAL_LOAD": 4359}
PRICE_SIGNALS = {
    "DE_LU": 4169, "AUSTRIA": 4170, "FRANCE": 254, "NETHERLANDS": 256, "POLAND": 258,
    "SWITZERLAND": 259, "CZECHIA": 261, "DENMARK_1": 252, "DENMARK_2": 253,
}
FORECAST_SIGNALS = {
    "TOTAL_CONSUMPTION_FC": 411, "RESIDUAL_LOAD_FC": 4362, "TOTAL_GENERATION_FC": 122,
    "WIND_ONSHORE_FC": 123, "SOLAR_FC": 125, "WIND_OFFSHORE_FC": 3791, "WIND_PV_FC": 5097,
}
ENERGY_GROUPS = {
    "renewable": ["WIND_ONSHORE", "WIND_OFFSHORE", "SOLAR", "BIOMASS", "HYDROPOWER", "OTHER_RENEWABLE"],
    "fossil": ["NATURAL_GAS", "HARD_COAL", "BROWN_COAL", "OTHER_CONVENTIONAL"],
    "nuclear": ["NUCLEAR"],
    "storage": ["PUMPED_STORAGE"],
}
WEATHER_VARIABLES = {
    "wind_speed_100m": "km/h", "wind_direction_100m": "°", "shortwave_radiation": "W/m²",
    "cloud_cover": "%", "temperature_2m": "°C",
}
WEATHER_REGIONS = {
    "wind_region_brandenburg": "brandenburg", "wind_region_schleswig": "schleswig",
    "solar_region_bavaria": "bavaria", "solar_region_bawue": "bawue",
}
DIRECTION_VARIABLES = ["wind_direction_100m"]
RESOLUTIONS = ["hour", "quarterhour", "day", "week", "month", "year"]
MARKET_TZ = "Europe/Berlin"
NUCLEAR_RETIREMENT = "2023-04-15 00:00:00"
QUARTERHOUR_CUTOVER_UTC = "2025-09-29 22:00:00"  # 2025-09-30 00:00+02:00
SINGLE_RUN_START = "2024-03-14"
SEASONS = {12: "winter", 1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring",
           6: "summer", 7: "summer", 8: "summer", 9: "autumn", 10: "autumn", 11: "autumn"}
SEASON_ORDER = ["winter", "spring", "summer", "autumn"]
# German nation-wide public holidays: fixed (month, day) and Easter offsets.
FIXED_HOLIDAYS = [
    (1, 1, "Neujahr"), (5, 1, "Erster Mai"), (10, 3, "Tag der Deutschen Einheit"),
    (12, 25, "Erster Weihnachtstag"), (12, 26, "Zweiter Weihnachtstag"),
]
EASTER_HOLIDAYS = [
    (-2, "Karfreitag"), (1, "Ostermontag"), (39, "Christi Himmelfahrt"), (50, "Pfingstmontag"),
]
# Forecast issue rule: hour (market-local, day before delivery) per signal.
ISSUE_HOUR_LOCAL = {"TOTAL_CONSUMPTION_FC": 10}
ISSUE_HOUR_DEFAULT = 18
# ---------------------------------------------------------------------------


def _snake(name: str) -> str:
    return name.lower()


@dataclass(frozen=True)
class Catalog:
    """Roles of signals; the wide-column name of each signal.

    generation: summed into ``total_generation_mw`` (D1)
    load:       pivoted but not summed
    signed:     may be negative (B3); ``retired``: valid only up to a cut
    home_price / neighbours: price table and spread partners (C1/D6)
    forecasts:  forecast signal -> wide column (D2); summed into nothing
    """
    generation: dict[str, str]
    load: dict[str, str]
    signed: tuple[str, ...]
    retired: dict[str, str]
    home_price: str
    neighbours: dict[str, str]
    forecasts: dict[str, str]
    forecast_signed: tuple[str, ...]
    weather_regions: dict[str, str] = field(default_factory=lambda: dict(WEATHER_REGIONS))
    weather_variables: dict[str, str] = field(default_factory=lambda: dict(WEATHER_VARIABLES))
    direction_variables: tuple[str, ...] = tuple(DIRECTION_VARIABLES)
    groups: dict[str, list[str]] = field(default_factory=dict)

    @property
    def generation_load(self) -> dict[str, str]:
        return {**self.generation, **self.load}

    def weather_columns(self, suffix: str = "") -> list[tuple[str, str, str]]:
        """(region, variable, column) in region-major order, H28 template."""
        return [(r, v, f"{v}_{alias}{suffix}")
                for r, alias in self.weather_regions.items()
                for v in self.weather_variables]

    def table_of(self) -> list[tuple[str, str]]:
        """(signal, table) routing rows (A22); a signal may feed several tables."""
        rows = [(s, "generation") for s in self.generation_load]
        rows += [(self.home_price, "prices")]
        rows += [(s, "neighbour_prices") for s in self.neighbours]
        return rows


ENERGY = Catalog(
    generation={s: f"{_snake(s)}_mw" for s in GENERATION_SIGNALS},
    load={s: f"{_snake(s)}_mw" for s in LOAD_SIGNALS},
    signed=("PUMPED_STORAGE", "TOTAL_CONSUMPTION", "RESIDUAL_LOAD"),
    retired={"NUCLEAR": NUCLEAR_RETIREMENT},
    home_price="DE_LU",
    neighbours={s: _snake(s) for s in PRICE_SIGNALS if s != "DE_LU"},
    forecasts={"WIND_ONSHORE_FC": "wind_onshore_forecast_mw", "WIND_OFFSHORE_FC": "wind_offshore_forecast_mw",
               "SOLAR_FC": "solar_forecast_mw", "WIND_PV_FC": "wind_pv_forecast_mw",
               "TOTAL_GENERATION_FC": "total_generation_forecast_mw",
               "RESIDUAL_LOAD_FC": "residual_load_forecast_mw",
               "TOTAL_CONSUMPTION_FC": "total_consumption_forecast_mw"},
    forecast_signed=("RESIDUAL_LOAD_FC", "TOTAL_CONSUMPTION_FC"),
    groups=ENERGY_GROUPS,
)
