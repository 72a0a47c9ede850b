"""Whole license texts, as words: lower case, without marks. Fixed values, written plainly."""

_MIT = """
permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal
in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies
of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and
this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any
kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event
shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising
from out of or in connection with the software or the use or other dealings in the software
"""

_ISC = """
permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright
notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this
software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or
consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other
tortious action arising out of or in connection with the use or performance of this software
"""

_BSD_CONDITIONS = """
redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1
redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary
form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials
provided with the distribution
"""

_BSD_NAMES = """
3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission
"""

_BSD_DISCLAIMER = """
this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the
implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be
liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or
services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or
tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage
"""

_UNLICENSE = """
this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this
software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that
recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain we make
this dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this software under copyright law the software is provided as is without warranty of
any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no
event shall the authors be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in
connection with the software or the use or other dealings in the software
"""

_ZLIB = """
this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the
use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and
redistribute it freely subject to the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote
the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required 2
altered source versions must be plainly marked as such and must not be misrepresented as being the original software 3 this notice may not be removed
or altered from any source distribution
"""

#: (label, words)
TEXTS = tuple(
    (label, " ".join(text.split()))
    for label, text in (
        ("mit", _MIT), ("isc", _ISC), ("bsd-2", _BSD_CONDITIONS + _BSD_DISCLAIMER), ("bsd-3", _BSD_CONDITIONS + _BSD_NAMES + _BSD_DISCLAIMER),
        ("unlicense", _UNLICENSE), ("zlib", _ZLIB),
    )
)
