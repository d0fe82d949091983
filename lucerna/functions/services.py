"""What names, links and texts tell about services."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rooms import cascade, holds
from .text import casefold, collapse, once
from .urls import absolute, scheme, service_url, site

# Words of kinds of service, names and parts of names that are none, words of links and texts that lead elsewhere.
KINDS = (("SECRETARY", ("segreteria", "secretary")), ("OFFICE", ("ufficio", "office")))
NO_NAMES = ("home", "campus", "i servizi del campus", "futuri studenti", "studenti iscritti", "laureati", "vivere il campus", "sistema museale")
NO_NAME_PARTS = ("cookie", "faq", "calendario", "concerto", "evento", "avviso", "festival", "seminario", "feed", "click day", "guida per gli studenti")
NO_DESCRIPTION = ("vai a tutte le notizie", "archivio notizie", "leggi tutte le notizie")
MENU_WORDS = ("home", "campus", "organizzazione")
LINK_WORDS = ("cookie", "rss", "faq", "calendario", "concerto", "evento", "avvisi", "seminario", "festival")


def service_type(name, about=None) -> Column:
    text = casefold(F.concat_ws(" ", name, F.lit("") if about is None else about))
    return once(text, lambda t: cascade([(holds(t, words), F.lit(kind)) for kind, words in KINDS], F.lit("SERVICE")))


def is_noise_name(name) -> Column:
    return once(casefold(name), lambda t: t.isin(*NO_NAMES) | holds(t, NO_NAME_PARTS))


def is_noise_description(text) -> Column:
    return once(casefold(text), lambda t: holds(t, NO_DESCRIPTION))


def service_link(base, href, text) -> Column:
    """The service page that a link of a list leads to; null for links to elsewhere, without words or with many."""
    to, said = absolute(base, href), F.lower(collapse(text))
    fine = ~F.rlike(href, F.lit("^(mailto|tel):")) & scheme(to).isin("http", "https") & (site(to) == site(base)) & ~holds(F.lower(to), ("lang=", "javascript:"))
    short = (said != "") & (F.size(F.split(said, " ")) <= 8) & (F.length(said) <= 80) & ~holds(said, MENU_WORDS) & ~holds(said, LINK_WORDS)
    found = service_url(to)
    return F.when(fine & short & (found != base), found)
