"""Fixed values that must equal the reference's for equal results."""

from __future__ import annotations

# File extensions that count as source code.
CODE_EXTENSIONS = [
    ".py", ".js", ".ts", ".tsx", ".jsx", ".html", ".css", ".scss", ".java", ".cpp", ".c", ".h", ".hpp",
    ".go", ".rs", ".rb", ".php", ".swift", ".kt", ".md", ".mdx", ".json", ".yaml", ".yml", ".toml",
    ".sql", ".graphql", ".sh", ".bash", ".r", ".cs", ".vue", ".svelte",
]

# A directory is skipped when its lower-cased path contains one of these anywhere.
SKIPPED_DIRECTORIES = [
    "node_modules", ".git", "venv", "env", "__pycache__", ".idea", ".vscode", "dist", "build", "out",
    "target", "coverage", ".next", ".nuxt", ".angular", "tmp", "cache",
]

# A file is skipped when its name contains one of these.
SKIPPED_NAMES = [".min.", "bundle", ".lock", "-lock"]

# An archive entry is skipped when its lower-cased path contains one of these.
SKIPPED_ENTRIES = [
    "/test/", "/tests/", ".min.", "/node_modules/", "/dist/", "/build/", "/out/", "vendor/",
]

# Fragments taken from each source, in this order.
SOURCE_QUOTAS = {
    "codigo_github": 90_580,
    "codigo_local": 10_002,
    "wikipedia": 40_165,
    "gutenberg": 40_000,
    "dialogos_naturales": 80_000,
    "opensubtitles_es": 30_000,
}

# Caps of the readers.
MAX_DIALOGUE_FRAGMENTS = 300_000
MAX_SUBTITLE_FRAGMENTS = 100_000
MAX_ARCHIVE_FRAGMENTS = 200_000
MAX_LOCAL_FRAGMENTS = 10_000
FILES_PER_REPO = 50
MAX_ENTRY_BYTES = 200_000

SEED = 42

# Marks of the two roles in fine-tuning text.
HUMAN = "<human>:"
ASSISTANT = "<assistant>:"

# Texts the vocabulary must reproduce.
ROUND_TRIP_TEXTS = [
    "function login(user, password)",
    "def calcular(a, b):",
    "import torch",
    "const usuario = await db.findOne({ id })",
    "El aprendizaje automático",
    "La inteligencia artificial es fascinante",
    "implementación, función, árbol, índice",
]

# Topic categories in order of priority, with the keywords looked for in a title.
TOPICS = {
    "Ciencia y Tecnología": [
        "tecnología", "física", "química", "biología", "matemática", "computación", "red", "sistema",
        "procesamiento", "digital", "ia", "inteligencia", "algoritmo", "protocolo", "internet", "web",
        "código", "software", "hardware", "espacio", "cuántica", "energía", "ciencia", "dato",
        "información", "ingeniería", "mecánica", "eléctrica", "nanotecnología",
    ],
    "Historia y Política": [
        "historia", "imperio", "guerra", "revolución", "dinastía", "tratado", "rey", "reina",
        "presidente", "política", "democracia", "estado", "socialismo", "comunismo", "fascismo",
        "nacionalismo", "independencia", "batalla", "siglo", "edad", "antigua", "moderna",
        "contemporánea", "constitucional", "parlamentario", "derecho", "paz", "crisis", "mundial",
    ],
    "Geografía y Naturaleza": [
        "río", "lago", "mar", "océano", "desierto", "montaña", "cordillera", "isla", "país", "ciudad",
        "capital", "continente", "animal", "planta", "bosque", "selva", "clima", "planeta", "estrella",
        "galaxia", "antártida", "amazonas", "nilo", "mediterráneo", "península", "caída", "población",
        "parque", "natural",
    ],
    "Cultura y Entretenimiento": [
        "música", "cine", "película", "banda", "arte", "literatura", "novela", "pintura", "teatro",
        "escultura", "arquitectura", "videojuego", "juego", "youtuber", "streamer", "influencer",
        "serie", "actor", "actriz", "cantante", "álbum", "canción", "festival", "museo", "cultura",
        "moda", "fotografía", "cómic", "animación", "danza", "poesía", "estilo",
    ],
    "Deportes": [
        "fútbol", "baloncesto", "tenis", "estadio", "copa", "mundial", "liga", "campeón", "atleta",
        "jugador", "deporte", "olímpic", "fórmula_1", "gran_premio", "tour", "vuelta", "derbi", "club",
        "entrenador", "fichaje", "maracaná", "wembley", "bernabéu", "camp_nou",
    ],
    "Economía y Empresa": [
        "mercado", "empresa", "economía", "financiero", "banco", "comercio", "inversión", "negocio",
        "marketing", "pnb", "pib", "inflación", "moneda", "startup", "amazon", "google", "facebook",
        "microsoft", "apple", "tesla", "netflix", "bolsa", "valor", "precio", "consumo",
    ],
    "Sociedad y Humanidades": [
        "psicología", "sociología", "ética", "filosofía", "religión", "educación", "sociedad",
        "derechos", "civilización", "persona", "mente", "conciencia", "lenguaje", "lingüística",
        "comunicación", "social", "humano", "conocimiento", "identidad", "feminismo", "racismo",
        "pobreza", "bienestar",
    ],
}
OTHER_TOPIC = "Varios / Biografías"
