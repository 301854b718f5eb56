"""Published table and column names, so that raw files load and existing SQL runs unchanged.

Inside the package every table uses the short names; ``internal`` renames a raw table on the way in, and
``published`` / ``register_published`` rename tables on the way out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# Short name -> published name. A column keeps its name if it is not listed.
TABLES = {
    "raw_telemetry": "raw_flotation_telemetry",
    "raw_maintenance": "raw_caex_maintenance",
    "raw_safety": "raw_safety_incidents",
    "raw_yearbook": "raw_cochilco_anuario",
    "raw_daily_price": "raw_cen_cmg_diario",
    "raw_hourly_price": "cen_cmg_hourly",
    "equipment": "dim_equipos_caex",
    "stg_telemetry": "stg_flotation",
    "stg_maintenance": "stg_maintenance",
    "stg_safety": "stg_safety",
    "equipment_performance": "int_equipment_performance",
    "shift_kpis": "fct_daily_mining_kpis",
    "failure_features": "ml_predictive_maintenance",
    "process_features": "ml_ore_grade_prediction",
    "stg_yearbook": "stg_cochilco__anuario",
    "yb_producers": "stg_cochilco__produccion_faena",
    "yb_totals": "stg_cochilco__produccion_total",
    "yb_grades": "stg_cochilco__ley_mineral",
    "yb_indices": "stg_cochilco__indices_faena",
    "yb_energy": "stg_cochilco__energia_proceso",
    "yb_intensity": "stg_cochilco__intensidad_energia",
    "yb_water": "stg_cochilco__agua",
    "yb_prices": "stg_cochilco__precios",
    "dim_producer": "dim_faena_cobre",
    "producer_year": "fct_cobre_faena_anual",
    "sector_year": "fct_sector_cobre_anual",
    "stg_price": "stg_cen__cmg_diario",
    "price_monthly": "fct_cmg_mensual_barra",
    "energy_cost_year": "fct_costo_electrico_cobre_anual",
}
COLUMNS = {
    "site": "faena",
    "day": "fecha",
    "shift": "turno",
    "tons": "tonelaje_hora_ton",
    "feed": "ley_alimentacion_cu_pct",
    "conc": "ley_concentrado_cu_pct",
    "tail": "ley_cola_cu_pct",
    "dose": "dosis_reactivo_gpt",
    "ph": "ph_pulpa",
    "truck": "camion_id",
    "model": "modelo",
    "cap_t": "capacidad_nominal_ton",
    "cyc_h": "ciclos_hora_nominal",
    "sched_h": "horas_turno_programadas",
    "oper_h": "horas_operativas",
    "maint_h": "horas_mantencion_programada",
    "fail_h": "horas_falla_no_programada",
    "cycles": "num_ciclos",
    "fill": "fill_factor",
    "sev": "severidad",
    "kind": "tipo_incidente",
    "down_h": "horas_detencion_asociadas",
    "payload_t": "tonelaje_transportado_ton",
    "availability": "disponibilidad_pct",
    "rate_real": "tasa_ton_hora_real",
    "rate_nominal": "tasa_ton_hora_nominal",
    "performance": "desempeno_pct",
    "n_trucks": "n_camiones_activos",
    "availability_pct": "tiee_pct",
    "performance_pct": "desempeno_pct",
    "quality_pct": "calidad_pct",
    "recovery_pct": "recuperacion_cu_pct",
    "processed_t": "tonelaje_procesado_total_ton",
    "incidents": "total_incidentes",
    "serious_incidents": "incidentes_graves_fatales",
    "risk_score": "puntaje_riesgo_operacional",
    "risk_level": "nivel_riesgo",
    "oper_h_total": "horas_operativas_acumuladas",
    "maint_h_7": "horas_mantencion_rolling_7t",
    "fail_h_7": "horas_falla_rolling_7t",
    "availability_7": "disponibilidad_rolling_7t",
    "shifts_since_failure": "turnos_desde_ultima_falla",
    "failed": "falla_no_programada_flag",
    "fails_next_shift": "falla_siguiente_turno",
    "tons_6": "tonelaje_rolling_6h",
    "feed_lag": "ley_alimentacion_lag_1h",
    "feed_sd_6": "ley_alimentacion_volatilidad_6h",
    "dose_6": "dosis_reactivo_rolling_6h",
    "ph_6": "ph_pulpa_rolling_6h",
    "conc_lag": "ley_concentrado_lag_1h",
    "target_conc": "target_ley_concentrado_cu_pct",
    "target_recovery": "target_recuperacion_cu_pct",
    "tab": "tabla",
    "ord": "orden",
    "lvl": "nivel",
    "label": "etiqueta",
    "parent": "padre",
    "grp": "grupo",
    "yr": "anio",
    "value": "valor",
    "value_text": "valor_original",
    "unit": "unidad",
    "mine": "faena",
    "owner": "propiedad",
    "output_kt": "produccion_kt",
    "first_yr": "primer_anio",
    "last_yr": "ultimo_anio",
    "output_total_kt": "produccion_acumulada_kt",
    "share_pct": "participacion_pct",
    "change_kt": "variacion_kt",
    "entity": "entidad",
    "cost_index": "indice_costo",
    "productivity_index": "indice_productividad",
    "state_kt": "codelco_kt",
    "private_kt": "privados_kt",
    "mill_grade": "ley_concentradora_pct",
    "heap_grade": "ley_lixiviacion_pilas_pct",
    "dump_grade": "ley_lixiviacion_rom_pct",
    "mean_grade": "ley_promedio_pct",
    "process": "proceso",
    "source": "fuente",
    "mj_per_t_metal": "mj_por_t_fino",
    "mj_per_t_material": "mj_por_t_procesada",
    "large_m3_t": "gran_mineria_m3_t",
    "medium_m3_t": "mediana_mineria_m3_t",
    "national_m3_t": "nacional_m3_t",
    "exchange": "bolsa",
    "mean_usc_lb": "promedio_usc_lb",
    "min_usc_lb": "minimo_usc_lb",
    "max_usc_lb": "maximo_usc_lb",
    "bus": "barra",
    "zone": "zona",
    "mon": "mes",
    "month": "mes",
    "days": "dias",
    "hours": "horas",
    "price_mean": "cmg_promedio_usd_mwh",
    "price_solar": "cmg_horas_solares_usd_mwh",
    "price_night": "cmg_noche_usd_mwh",
    "night_solar_gap": "brecha_noche_solar_usd_mwh",
    "priced_days": "dias_con_precio",
    "price": "cmg_promedio_usd_mwh",
    "electricity_mwh": "electricidad_total_mwh",
    "cost_musd": "costo_spot_electricidad_musd",
    "mill_cost_musd": "costo_spot_concentradora_musd",
    "cost_usd_per_t": "costo_spot_usd_por_t_cobre",
}
# Columns that a table publishes under another name than the rest.
EXCEPTIONS = {
    "shift_kpis": {"payload_t": "tonelaje_transportado_total_ton", "down_h": "horas_detencion_seguridad"},
    "sector_year": {
        "output_kt": "produccion_total_kt",
        "state_output_kt": "produccion_codelco_kt",
        "state_share_pct": "participacion_codelco_pct",
        "energy_tj": "energia_total_tj",
        "electricity_tj": "electricidad_total_tj",
        "mill_electricity_tj": "electricidad_concentradora_tj",
        "mill_mj_per_t": "concentradora_mj_t_procesada",
        "mill_kwh_per_t": "concentradora_kwh_t_procesada",
        "mill_mj_per_t_metal": "concentradora_mj_t_fino",
        "mill_water_m3_t": "agua_concentracion_m3_t",
        "leach_water_m3_t": "agua_hidrometalurgia_m3_t",
        "price_usc_lb": "precio_lme_usc_lb",
    },
    "yb_energy": {"energy_tj": "energia_tj"},
    "raw_hourly_price": {"day": "date", "hour": "hour", "bus": "bar", "price": "cmg_usd_mwh"},
}


def published_name(table: str, column: str) -> str:
    return EXCEPTIONS.get(table, {}).get(column, COLUMNS.get(column, column))


def published(df: DataFrame, table: str) -> DataFrame:
    """The table with its published column names."""
    return df.select(*[df[c].alias(published_name(table, c)) for c in df.columns])


def internal(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """A raw table with published column names, as the short-named ``columns``."""
    return df.select(*[df[published_name(table, c)].alias(c) for c in columns])


def register_published(tables: Mapping[str, DataFrame]) -> None:
    """A temporary view for each table, under its published name and with its published columns."""
    for name, df in tables.items():
        published(df, name).createOrReplaceTempView(TABLES[name])
