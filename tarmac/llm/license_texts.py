"""Whole public licence texts (``licenses/``, as published) in the forms that they usually stand in.

A form is a title (or none), with or without the "All rights reserved." line,
then the text, whole or without its appendix on how to apply it.  The other
published addresses of the Free Software Foundation, http and https, numbered
or bulleted clauses are forms too.
"""

from __future__ import annotations

import re
from importlib.resources import files

# license id: (lines of the published title, other titles); "" is no title
TITLES = {
    "Apache-2.0": (3, ["", "Apache License\nVersion 2.0, January 2004", "Apache License, Version 2.0", "Apache License 2.0"]),
    "Artistic-1.0-Perl": (1, ["", "The Artistic License 1.0", "Artistic License"]),
    "BSD-3-Clause": (0, ["BSD 3-Clause License", "The BSD 3-Clause License", "3-Clause BSD License", "The 3-Clause BSD License",
                         "BSD License", "The BSD License", "New BSD License", "The New BSD License", "Modified BSD License"]),
    "BSD-2-Clause": (0, ["BSD 2-Clause License", "The BSD 2-Clause License", "2-Clause BSD License", "The 2-Clause BSD License",
                         "BSD License", "The BSD License", "Simplified BSD License", "FreeBSD License"]),
    "CC0-1.0": (2, ["", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal"]),
    "GFDL-1.2": (2, ["", "GNU Free Documentation License"]),
    "GFDL-1.3": (2, ["", "GNU Free Documentation License"]),
    "GPL-1.0": (2, ["", "GNU General Public License"]),
    "GPL-2.0": (2, ["", "GNU General Public License", "The GNU General Public License (GPL)\nVersion 2, June 1991"]),
    "GPL-3.0": (2, ["", "GNU General Public License"]),
    "LGPL-2.0": (2, ["", "GNU Library General Public License"]),
    "LGPL-2.1": (2, ["", "GNU Lesser General Public License"]),
    "LGPL-3.0": (2, ["", "GNU Lesser General Public License"]),
    "MPL-1.1": (2, ["", "Mozilla Public License 1.1 (MPL 1.1)"]),
    "MPL-2.0": (1, ["", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0"]),
    "MIT": (0, ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"]),
    "ISC": (0, ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"]),
    "0BSD": (0, ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD 0-Clause License", "0BSD"]),
}
RESERVED = "All rights reserved."
#: licences that usually have that line after the copyright line
WITH_RESERVED = ("BSD-3-Clause", "BSD-2-Clause", "MIT", "ISC", "0BSD")
APPENDIX = r"\n[^\n]*(APPENDIX: How to apply|How to Apply These Terms|ADDENDUM: How to use)"
END = r"\n *END OF TERMS AND CONDITIONS *$"
ADDRESS = r"51 Franklin St(reet)?, Fifth Floor, Boston,? MA +02110-1301 +USA"
ADDRESSES = ["59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "675 Mass Ave, Cambridge, MA 02139, USA"]
REGENTS = [("the University nor", "the copyright holder nor"), ("THE REGENTS AND CONTRIBUTORS", "THE COPYRIGHT HOLDERS AND CONTRIBUTORS"),
           ("THE REGENTS OR CONTRIBUTORS", "THE COPYRIGHT HOLDER OR CONTRIBUTORS")]
THIRD = r"3\. Neither the name(.|\n)*?permission\.\n"


def _published(name: str) -> str:
    text = files("tarmac.llm").joinpath("licenses", f"{name}.txt").read_text("utf-8")
    return text.replace("\f", "")


def _bodies(name: str, known: dict[str, str]) -> tuple[str, list[str]]:
    """The published title and the texts without it."""
    if name in known:
        bodies = [known[name]]
        if name == "ISC":
            bodies.append(known[name].replace("and/or", "and"))
        return "", bodies
    if name in ("BSD-3-Clause", "BSD-2-Clause"):
        regents = _published("BSD-3-Clause").split(RESERVED, 1)[1]
        holder = regents
        for a, b in REGENTS:
            holder = holder.replace(a, b)
        both = [regents, holder] if name == "BSD-3-Clause" else [re.sub(THIRD, "", t) for t in (regents, holder)]
        return "", both + [re.sub(r"(?m)^[123]\. ", "* ", t) for t in both]
    lines = [x for x in _published(name).splitlines() if x.strip()]
    n = TITLES[name][0]
    body = "\n".join(lines[n:])
    bodies = [body]
    if re.search(APPENDIX, body):
        bodies.append(body[: re.search(APPENDIX, body).start()])
        bodies.append(re.sub(END, "", bodies[-1]))
    return "\n".join(lines[:n]), bodies


def heads_and_bodies(known: dict[str, str]) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """(license id, head) and (license id, body); a form is a head and a body of one licence.

    ``known`` has the texts of the licences that are not shipped as files.
    """
    all_heads, all_bodies = [], []
    for name, (_, titles) in TITLES.items():
        own, bodies = _bodies(name, known)
        bodies = bodies + [re.sub(ADDRESS, a, b) for b in bodies for a in ADDRESSES if re.search(ADDRESS, b)]
        bodies = bodies + [b.replace(x, y) for b in bodies for x, y in (("http://", "https://"), ("https://", "http://"))]
        heads = [f"{t}\n{line}" for t in [own, *titles] for line in ["", RESERVED][: 1 + (name in WITH_RESERVED)]]
        all_heads += [(name, x) for x in dict.fromkeys(heads)]
        all_bodies += [(name, x) for x in dict.fromkeys(bodies)]
    return all_heads, all_bodies
