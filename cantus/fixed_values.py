"""Fixed values.

Everything in this file is a constant that must equal the published behaviour for
results to be right: label codes, feature names, value ranges, score weights, activity
profiles, keyword rules, defaults and formats.  They are stated as plain data, in their
natural order.  Long word lists (the mood lexicon, the training phrases) are parameters
of the operators that use them; the small defaults here are our own.
"""

# --- labels -----------------------------------------------------------------------------
MOODS = ("sad", "happy", "energetic", "calm")  # position = label code
MOOD_CODE = {name: code for code, name in enumerate(MOODS)}

# Free-text mood names accepted from users; anything else means "happy".
MOOD_ALIASES = {
    "triste": "sad",
    "sad": "sad",
    "feliz": "happy",
    "alegre": "happy",
    "happy": "happy",
    "energico": "energetic",
    "energética": "energetic",
    "energetica": "energetic",
    "energetic": "energetic",
    "calmado": "calm",
    "tranquilo": "calm",
    "calm": "calm",
}
DEFAULT_MOOD = "happy"

# --- features and their valid ranges ------------------------------------------------------
UNIT_FEATURES = (
    "danceability",
    "energy",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
    "valence",
)
SHARED_FEATURES = (*UNIT_FEATURES, "loudness", "tempo", "duration_ms")
RECOMMENDER_FEATURES = (*UNIT_FEATURES, "loudness", "tempo", "spec_rate", "duration_ms")
LOUDNESS_RANGE = (-80.0, 10.0)
BUCKET_EDGES = (0.33, 0.66)
BUCKETS = ("low", "mid", "high")

# --- defaults -------------------------------------------------------------------------------
TEXT_FILL = "unknown"
LYRICS_GENRE = "spotify_unknown"
REALTIME_SOURCE = "realtime_prediction"
METADATA_DEFAULTS = {
    "track_name": "Track sin nombre",
    "artists": "Artista desconocido",
    "album_name": "Album desconocido",
    "track_genre": "realtime_input",
    "popularity": 0,
    "explicit": False,
}
UPLOAD_ALIASES = {
    "duration_(ms)": "duration_ms",
    "duration": "duration_ms",
    "name": "track_name",
    "artist": "artists",
    "genre": "track_genre",
    "id": "track_id",
    "url": "spotify_url",
    "track_url": "spotify_url",
    "spotify_track_url": "spotify_url",
}
TRUE_WORDS = ("true", "1", "yes", "si", "sí")
ALL_GENRES_WORDS = ("", "todos", "todas", "all", "none")

# --- formats -----------------------------------------------------------------------------------
TRACK_URL_PATTERN = (
    r"^https://open\.spotify\.com/(?:intl-[a-z]{2}/)?track/([A-Za-z0-9]{22})(?:[?/#].*)?$"
)
TRACK_URL_PREFIX = "https://open.spotify.com/intl-es/track/"

# --- activity profiles ---------------------------------------------------------------------------
PROFILE = (
    "activity_movement",
    "activity_energy",
    "activity_positivity",
    "activity_focus",
    "activity_calm",
    "activity_acoustic",
)
GENERAL_ACTIVITY = "actividad_general"

# Serving prototypes, in tie-break order; values follow PROFILE.
PROTOTYPES = {
    "desahogo_emocional": (0.00, 0.05, 0.05, 0.30, 0.95, 0.85),
    "entrenamiento_intenso": (0.95, 0.95, 0.65, 0.45, 0.10, 0.15),
    "correr": (1.00, 0.95, 0.70, 0.35, 0.05, 0.10),
    "baile_fiesta": (0.95, 0.90, 0.95, 0.20, 0.05, 0.05),
    "limpieza_domestica": (0.75, 0.70, 0.55, 0.35, 0.15, 0.20),
    "estudio_trabajo": (0.15, 0.25, 0.45, 0.95, 0.70, 0.75),
    "alimentacion": (0.10, 0.20, 0.55, 0.50, 0.65, 0.55),
    "relajacion": (0.05, 0.15, 0.55, 0.55, 0.95, 0.85),
    "dormir": (0.00, 0.05, 0.35, 0.60, 1.00, 0.95),
    "caminar_paseo": (0.45, 0.45, 0.65, 0.45, 0.50, 0.45),
    "conducir_viaje": (0.45, 0.60, 0.75, 0.45, 0.35, 0.25),
    "actividad_general": (0.45, 0.50, 0.55, 0.45, 0.35, 0.30),
}

# Training activities of the weak-supervision grid; values follow PROFILE.
GRID_ACTIVITIES = {
    "llorar": (0.00, 0.05, 0.05, 0.30, 0.95, 0.85),
    "desahogarme": (0.00, 0.10, 0.10, 0.35, 0.90, 0.80),
    "estar triste": (0.05, 0.10, 0.10, 0.35, 0.90, 0.80),
    "gym": (0.95, 0.95, 0.65, 0.45, 0.10, 0.15),
    "entrenar": (0.95, 0.95, 0.65, 0.45, 0.10, 0.15),
    "correr": (1.00, 0.95, 0.70, 0.35, 0.05, 0.10),
    "bailar": (0.95, 0.90, 0.95, 0.20, 0.05, 0.05),
    "limpiar": (0.75, 0.70, 0.80, 0.35, 0.15, 0.20),
    "estudiar": (0.15, 0.25, 0.45, 0.95, 0.70, 0.75),
    "trabajar": (0.20, 0.35, 0.55, 0.90, 0.55, 0.55),
    "relajarse": (0.05, 0.15, 0.55, 0.55, 0.95, 0.85),
    "dormir": (0.00, 0.05, 0.35, 0.60, 1.00, 0.95),
    "caminar": (0.45, 0.45, 0.65, 0.45, 0.50, 0.45),
    "conducir": (0.45, 0.60, 0.75, 0.45, 0.35, 0.25),
}

# --- keyword rules -----------------------------------------------------------------------------
GENERIC_WORDS = (
    "quiero", "necesito", "me", "apetece", "hacer", "algo", "plan", "planes", "un", "una", "que",
    "nada",
)

# keyword -> activity; the first keyword in this order that the text contains decides.
KEYWORD_HINTS = {
    "llor": "desahogo_emocional",
    "desahog": "desahogo_emocional",
    "gym": "entrenamiento_intenso",
    "entren": "entrenamiento_intenso",
    "pesas": "entrenamiento_intenso",
    "correr": "correr",
    "running": "correr",
    "bail": "baile_fiesta",
    "fiesta": "baile_fiesta",
    "cantar": "baile_fiesta",
    "reir": "baile_fiesta",
    "divert": "baile_fiesta",
    "limpiar": "limpieza_domestica",
    "fregar": "limpieza_domestica",
    "barrer": "limpieza_domestica",
    "lavar": "limpieza_domestica",
    "ordenar": "limpieza_domestica",
    "cocinar": "limpieza_domestica",
    "estudi": "estudio_trabajo",
    "trabaj": "estudio_trabajo",
    "program": "estudio_trabajo",
    "leer": "estudio_trabajo",
    "reunion": "estudio_trabajo",
    "comer": "alimentacion",
    "beber": "alimentacion",
    "tomar": "alimentacion",
    "almorz": "alimentacion",
    "cenar": "alimentacion",
    "desayun": "alimentacion",
    "merend": "alimentacion",
    "dorm": "dormir",
    "siest": "dormir",
    "relaj": "relajacion",
    "medit": "relajacion",
    "reflex": "relajacion",
    "pensar": "relajacion",
    "contempl": "relajacion",
    "introspec": "relajacion",
    "calmar": "relajacion",
    "desestres": "relajacion",
    "estres": "relajacion",
    "pase": "caminar_paseo",
    "caminar": "caminar_paseo",
    "pasear": "caminar_paseo",
    "vuelta": "caminar_paseo",
    "conduc": "conducir_viaje",
    "viaj": "conducir_viaje",
    "jugar": "actividad_general",
    "videoj": "actividad_general",
    "pelear": "actividad_general",
}

# keyword -> additive profile changes, in PROFILE order
# (movement, energy, positivity, focus, calm, acoustic); every matching keyword adds up.
KEYWORD_DELTAS = {
    "llor": (-0.35, -0.45, -0.35, 0.0, 0.45, 0.35),
    "desahog": (-0.25, -0.35, -0.25, 0.0, 0.40, 0.30),
    "gym": (0.40, 0.45, 0.0, 0.0, 0.0, 0.0),
    "entren": (0.40, 0.45, 0.0, 0.0, 0.0, 0.0),
    "pesas": (0.30, 0.40, 0.0, 0.0, 0.0, 0.0),
    "correr": (0.55, 0.55, 0.0, 0.0, 0.0, 0.0),
    "running": (0.55, 0.55, 0.0, 0.0, 0.0, 0.0),
    "bail": (0.45, 0.40, 0.35, 0.0, 0.0, 0.0),
    "fiesta": (0.40, 0.35, 0.45, 0.0, 0.0, 0.0),
    "cantar": (0.25, 0.25, 0.30, 0.0, 0.0, 0.0),
    "reir": (0.20, 0.20, 0.35, 0.0, 0.0, 0.0),
    "divert": (0.20, 0.20, 0.35, 0.0, 0.0, 0.0),
    "limpiar": (0.35, 0.25, 0.0, 0.0, 0.0, 0.0),
    "fregar": (0.35, 0.25, 0.0, 0.0, 0.0, 0.0),
    "barrer": (0.30, 0.20, 0.0, 0.0, 0.0, 0.0),
    "lavar": (0.25, 0.20, 0.0, 0.0, 0.0, 0.0),
    "ordenar": (0.25, 0.20, 0.0, 0.0, 0.0, 0.0),
    "cocinar": (0.20, 0.20, 0.0, 0.0, 0.0, 0.0),
    "estudi": (-0.20, 0.0, 0.0, 0.55, 0.25, 0.0),
    "trabaj": (-0.15, 0.0, 0.0, 0.45, 0.20, 0.0),
    "program": (-0.20, 0.0, 0.0, 0.55, 0.20, 0.0),
    "leer": (-0.20, 0.0, 0.0, 0.45, 0.25, 0.0),
    "reunion": (-0.10, 0.0, 0.0, 0.35, 0.15, 0.0),
    "comer": (-0.20, -0.20, 0.0, 0.0, 0.30, 0.0),
    "beber": (-0.10, -0.10, 0.0, 0.0, 0.20, 0.0),
    "tomar": (-0.10, -0.10, 0.0, 0.0, 0.20, 0.0),
    "almorz": (-0.15, -0.15, 0.0, 0.0, 0.25, 0.0),
    "cenar": (-0.20, -0.20, 0.0, 0.0, 0.30, 0.0),
    "desayun": (-0.15, -0.15, 0.0, 0.0, 0.20, 0.0),
    "merend": (-0.15, -0.15, 0.0, 0.0, 0.20, 0.0),
    "dorm": (-0.55, -0.60, 0.0, 0.0, 0.65, 0.0),
    "siest": (-0.50, -0.55, 0.0, 0.0, 0.60, 0.0),
    "relaj": (-0.25, -0.35, 0.0, 0.0, 0.45, 0.0),
    "medit": (-0.25, -0.35, 0.0, 0.0, 0.50, 0.0),
    "reflex": (-0.25, -0.30, 0.0, 0.35, 0.40, 0.20),
    "pensar": (-0.20, -0.25, 0.0, 0.30, 0.35, 0.0),
    "contempl": (-0.25, -0.30, 0.0, 0.25, 0.40, 0.0),
    "introspec": (-0.30, -0.35, 0.0, 0.35, 0.45, 0.20),
    "calmar": (-0.25, -0.30, 0.0, 0.0, 0.45, 0.0),
    "desestres": (-0.30, -0.35, 0.0, 0.0, 0.50, 0.0),
    "estres": (-0.20, -0.25, 0.0, 0.0, 0.35, 0.0),
    "pase": (0.20, -0.05, 0.0, 0.0, 0.20, 0.0),
    "caminar": (0.20, -0.05, 0.0, 0.0, 0.20, 0.0),
    "pasear": (0.20, -0.05, 0.0, 0.0, 0.20, 0.0),
    "vuelta": (0.15, -0.05, 0.0, 0.0, 0.20, 0.0),
    "conduc": (0.20, 0.0, 0.0, 0.20, 0.0, 0.0),
    "viaj": (0.20, 0.0, 0.15, 0.15, 0.0, 0.0),
    "jugar": (0.15, 0.15, 0.0, 0.15, 0.0, 0.0),
    "videoj": (0.10, 0.15, 0.0, 0.20, 0.0, 0.0),
}

# Phrase templates; "{}" stands for the base phrase, which is itself the first variant.
PHRASE_TEMPLATES = (
    "{}", "{} ahora", "voy a {}", "quiero {}", "tengo que {}", "necesito {}", "me apetece {}",
    "estoy para {}", "me toca {}", "hora de {}", "plan de {}", "vamos a {}",
)

# --- serving choices ------------------------------------------------------------------------
SCORE_RANGES = {
    "0.00 - 1.00": (0.0, 1.01),
    "0.75 - 1.00": (0.75, 1.01),
    "0.60 - 0.75": (0.60, 0.75),
    "0.45 - 0.60": (0.45, 0.60),
}
POOL_MULTIPLIER, MIN_POOL, MAX_POOL = 30, 50, 1000

REASONS = {
    "sad_release": "Prioriza canciones sad/calm para acompanar el estado sin forzar animo feliz.",
    "sad_workout": "Mantiene compatibilidad emocional, pero sube energia para la actividad.",
    "limpieza_domestica": "Interpreta la actividad como movimiento moderado y energia funcional.",
    "alimentacion": "Asume un momento de pausa: baja energia y un ritmo mas suave.",
    "relajacion": "Busca un ambiente calmado y con foco suave para reflexionar o desconectar.",
    "actividad_general": "No se detecta una actividad clara. Prueba con algo mas especifico para afinar.",
    "default": "Equilibra emocion indicada, actividad y caracteristicas musicales.",
}

DISPLAY_NAMES = {
    "track_name": "Cancion",
    "artists": "Artista",
    "track_genre": "Genero",
    "target_mood": "Mood objetivo",
    "predicted_mood": "Mood detectado",
    "mood_confidence": "Confianza mood",
    "popularity": "Popularidad",
    "activity_interpreted_as": "Actividad interpretada",
    "recommendation_score": "Score",
    "reason": "Motivo",
    "spotify_url": "Spotify",
    "track_id": "Track ID",
    "audio_predicted_mood": "Mood audio",
    "lyrics_predicted_mood": "Mood letra",
    "mood_contrast": "Contraste audio/letra",
    "danceability": "Danceability",
    "energy": "Energy",
    "speechiness": "Speechiness",
    "acousticness": "Acousticness",
    "instrumentalness": "Instrumentalness",
    "liveness": "Liveness",
    "valence": "Valence",
    "loudness": "Loudness",
    "tempo": "Tempo",
    "duration_ms": "Duration (ms)",
}

RECOMMENDATION_COLUMNS = (
    "track_name", "artists", "track_genre", "target_mood", "predicted_mood", "mood_confidence",
    "popularity", "activity_interpreted_as", "recommendation_score", "reason", "spotify_url",
    "track_id", "audio_predicted_mood", "lyrics_predicted_mood", "mood_contrast",
    *UNIT_FEATURES, "loudness", "tempo", "duration_ms",
)

# JSON keys searched for each field of a vendor payload, lower case.
PAYLOAD_KEYS = {
    "track_name": ("track_name", "trackname", "track_title", "tracktitle", "song", "song_name", "name", "title"),
    "artists": (
        "artists", "artist", "artist_name", "artistname", "artists_name", "artistnames",
        "author_name", "performer", "singer", "author",
    ),
    "genres": ("genres", "genre", "track_genre", "trackgenre", "style"),
    "popularity": ("popularity", "popularity_score", "popularityscore", "track_popularity", "score"),
    "album": ("album",),
    "album_name": ("album_name", "albumname", "album_title", "albumtitle"),
    "release_date": ("release_date", "release", "releasedate"),
    "cover": ("image", "image_url", "cover", "cover_url", "thumbnail", "images"),
    "duration": ("duration_ms", "duration", "durationms"),
    "id": ("id", "track_id"),
    "danceability": ("danceability",),
    "energy": ("energy",),
    "acousticness": ("acousticness",),
    "speechiness": ("speechiness",),
    "instrumentalness": ("instrumentalness",),
    "liveness": ("liveness",),
    "valence": ("happiness", "valence"),
    "tempo": ("tempo", "bpm"),
    "loudness": ("loudness", "loudness_db", "loudnessdb"),
}

# --- defaults of our own ---------------------------------------------------------------------
# A small starter lexicon; pass your own to any operator that takes one.
DEFAULT_LEXICON = {
    "sad": ("sad", "cry", "tears", "lonely", "triste", "llorar", "dolor", "pena"),
    "happy": ("happy", "smile", "joy", "sunny", "feliz", "alegria", "risa", "sol"),
    "energetic": ("run", "fire", "power", "jump", "fuerza", "fuego", "saltar", "vamos"),
    "calm": ("calm", "quiet", "slow", "peace", "calma", "paz", "lento", "silencio"),
}

# A small starter set of training phrases per activity.
DEFAULT_PHRASES = {
    "desahogo_emocional": ("llorar a solas", "soltar la pena"),
    "entrenamiento_intenso": ("hacer pesas", "una sesion de gimnasio"),
    "correr": ("salir a correr", "preparar una maraton"),
    "baile_fiesta": ("bailar con amigos", "celebrar un cumple"),
    "limpieza_domestica": ("fregar los platos", "ordenar el cuarto"),
    "estudio_trabajo": ("repasar el temario", "terminar un informe"),
    "alimentacion": ("cenar en familia", "tomar un cafe"),
    "relajacion": ("meditar en silencio", "descansar la mente"),
    "dormir": ("echar la siesta", "irme a la cama"),
    "caminar_paseo": ("dar un paseo", "caminar por el parque"),
    "conducir_viaje": ("conducir de noche", "viajar en coche"),
    "actividad_general": ("pasar el rato", "estar en casa"),
}
