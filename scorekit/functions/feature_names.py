"""Names of the monthly feature families, generated from their naming rules."""

# Family stems and horizons of the input tables.
BEHAVIOUR_STEMS = ["count", "perc_good", "atraso_medio", "atraso_minimo", "vl_pg_em_dia", "vl_total"]
BEHAVIOUR_MONTHS = ["m01", "m02", "m03", "m04", "m05"]
AMOUNT_STEMS = ["valor_recebido_boletos", "total_cartao_recebido", "total_ted_recebido",
                "total_recebido"]
AMOUNT_HORIZONS = ["3M", "6M", "12M"]
CONCENTRATION_STEMS = ["ind_Hefindahl_H_paga", "ind_Hefindahl_H_bene"]
CONCENTRATION_HORIZONS = ["1m", "2m", "3m", "6m", "12m"]
LIQUIDITY_STEMS = ["cedente_indice_liquidez", "sacado_indice_liquidez"]
LIQUIDITY_HORIZONS = ["1m", "2m", "3m", "6m"]
RANKING_STEMS = ["vl_pago_boletos", "vl_recebido_boletos"]
RANKING_HORIZONS = ["", "_sum_2m", "_sum_3m", "_sum_6m", "_sum_9m", "_sum_12m"]
TREND_KINDS = ["credito", "debito", "antecipacao", "total"]
TREND_HORIZONS = [1, 2, 3, 6, 12]
KEY_COLUMNS = ["INDEX", "num_digitos_cnpj", "tipo_cnpj", "radical_cnpj", "completo_cnpj"]

BEHAVIOUR = [f"{stem}_{m}" for m in BEHAVIOUR_MONTHS for stem in BEHAVIOUR_STEMS]
AMOUNTS = [f"{stem}_{h}" for stem in AMOUNT_STEMS for h in AMOUNT_HORIZONS]
CONCENTRATION = [f"{stem}_{h}" for h in CONCENTRATION_HORIZONS for stem in CONCENTRATION_STEMS]
LIQUIDITY = [f"{stem}_{h}" for stem in LIQUIDITY_STEMS for h in LIQUIDITY_HORIZONS]
RANKING = [f"{stem}{h}_ranking" for stem in RANKING_STEMS for h in RANKING_HORIZONS]
TREND = [f"vl_recebido_cartao_{kind}_avg_{a}m_{b}m_trend" for kind in TREND_KINDS
         for i, a in enumerate(TREND_HORIZONS) for b in TREND_HORIZONS[i + 1:]]
