"""Keyword lists, extensions, codes and file-name patterns."""

# Words that name a municipal plan in link text and paths.
PLAN_WORDS = ["pdm", "plano diretor municipal", "plano director municipal"]
REGULATION_WORD = "regulamento"
# Further words of links worth following.
NAVIGATION_WORDS = [*PLAN_WORDS, "urbanismo", "planeamento", "ordenamento do territorio", "instrumentos de gestao territorial", "regulamentos", REGULATION_WORD]
# Parts of a site that are never followed.
SKIPPED_PATHS = ["noticias", "eventos", "agenda", "imprensa", "galeria"]
# Endings of links that are documents, not pages.
DOCUMENT_ENDINGS = [".jpg", ".jpeg", ".png", ".gif", ".svg", ".ico", ".css", ".js", ".zip", ".rar", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".mp3", ".mp4", ".avi", ".pdf"]
# Endings of files, as the older crawler knows them.
FILE_ENDINGS = [".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".zip", ".rar", ".7z", ".tar", ".gz", ".jpg", ".jpeg", ".png", ".gif", ".bmp", ".svg", ".mp3", ".mp4", ".avi", ".mov", ".wmv", ".txt", ".csv", ".xml", ".json"]
PAGE_ENDINGS = [".html", ".htm", ".php", ".asp", ".aspx", ".jsp"]
# Words in the paths of plan documents.
PLAN_PATH_WORDS = ["pdm", "plano diretor municipal", "plano_diretor", "pdm_municipal", "plano-diretor", "estratégia municipal", "ordenamento do território"]
# Squashed words of the second plan detector.
SQUASHED_PLAN_WORDS = ["pdm", "planodiretormunicipal"]
# Words expected in a plan's text.
CONTENT_WORDS = ["solo", "plano", "ordenamento", "territorio", "urbanistico", "edificabilidade", "servidao", "reserva ecologica", "reserva agricola"]
# Scoring terms of candidate documents.
SCORE_TERMS = [
    "ordenamento do território", "plano diretor municipal", "zonamento", "usos do solo", "ocupação do solo", "solo urbano", "solo urbanizável", "solo rural",
    "perímetro urbano", "áreas urbanas", "zonas residenciais", "zonas industriais", "zona agrícola", "espaços verdes", "edificabilidade", "índice de construção",
    "densidade populacional", "cércea", "equipamentos coletivos", "infraestruturas urbanas", "rede viária", "servidões administrativas", "condicionantes",
    "reserva ecológica nacional", "reserva agrícola nacional", "domínio público", "planta de ordenamento", "planta de condicionantes", "regulamento municipal",
    "revisão do plano", "alteração por adaptação",
]
# Scoring terms of best files; short ones count inside other words too.
FILE_TERMS = [
    "pdm", "plano diretor municipal", "plano diretor", "solos", "ordenamento do território", "ordenamento territorial", "uso do solo", "ocupação do solo", "zonamento",
    "planta de ordenamento", "planta de condicionantes", "estratégia municipal", "gestão territorial", "desenvolvimento sustentável", "modelo territorial",
    "regulamento", "regulamento municipal", "rjigt", "regime jurídico dos instrumentos de gestão territorial", "reserva ecológica nacional", "ren",
    "reserva agrícola nacional", "ran", "estrutura ecológica", "urbanização", "edificação", "perímetro urbano", "áreas urbanas", "áreas de edificação consolidada",
    "servidão", "servidões administrativas", "infraestruturas urbanas", "espaços verdes", "equipamentos coletivos", "equipamentos públicos", "rede viária",
    "mobilidade", "habitação", "atividades económicas", "actividades económicas", "unidades operativas de planeamento", "uop", "unidades de execução", "prot",
    "plano regional de ordenamento do território",
]
# Code prefixes of region hints, and names that differ between sources.
REGION_PREFIXES = {"açores": "4", "madeira": "31", "algarve": "08"}
NAME_ALIASES = {"Praia da Vitória": "Vila da Praia da Vitória"}
# Path segments of the election pages and the fields they fill.
LINK_FIELDS = {
    "PresidenciaRepublica": "president_url",
    "AssembleiaRepublica": "parliament_url",
    "AutarquiasLocais": "town_hall_url",
    "Regionais": "regional_assembly_url",
    "ParlamentoEuropeu": "european_url",
}
# File-name patterns of election results.
FILE_PATTERNS = {
    "european": r"(?iu)^PE(\d{4}).*\.xlsx?$",
    "parliament": r"(?iu)^(?:AR|AC)[_ ]?(\d{4}).*\.xlsx?$",
    "presidential": r"(?iu)^PR[_ ]?(\d{4}).*\.xlsx?$",
    "regional": r"(?iu)^resultados[ _]*alra(m|a)(\d{4})\.xlsx?$",
    "town_hall": r"(?iu)^resultados_eleicoes_(?:aut(\d{2})_(cm|am|af)|(cm|am|af)_(\d{4}))\.xlsx?$",
}
CHAMBERS = {"cm": "council", "am": "assembly", "af": "parish_assembly"}
REGIONS = {"m": "madeira", "a": "azores"}
SUB_TYPES = {"town_hall": ["council", "assembly", "parish_assembly"], "regional": ["madeira", "azores"]}
ELECTION_TYPES = ["presidential", "parliament", "town_hall", "regional", "european"]
URBANIZATION_LABEL = "Regulamento Municipal da Urbanização e da Edificação"
FEES_LABEL = "Regulamento de Taxas e Cauções por Operações Urbanísticas"
